"""A4: only an absent path counts as absent."""

import pytest

from larder.sources.io import optional_row_count


def test_absent_is_null_and_unreadable_raises(spark, tmp_path):
    assert optional_row_count(spark, str(tmp_path / "none.parquet")).first()[0] is None
    bad = tmp_path / "text.parquet"
    bad.write_text("not a table")
    with pytest.raises(Exception):
        optional_row_count(spark, str(bad)).collect()
