"""Plain window forms of the peer statistics, to check the library against."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.operators.peers import _c, _split_spec, _z


def peer_percentiles_window(df, measures, keys):
    spec = _split_spec(measures, keys)
    cols = {}
    for name, (expr, keys) in spec.items():
        part = Window.partitionBy(*keys)
        n = F.count(F.lit(1)).over(part)
        x = expr.cast("double")
        ordered = part.orderBy(x.asc_nulls_last())
        first = F.rank().over(ordered)
        # ties = the value's peers: same ordering, RANGE frame on the current
        # value, so rank and tie count share one sort
        ties = F.count(F.lit(1)).over(ordered.rangeBetween(Window.currentRow, Window.currentRow))
        cols[name] = F.when(x.isNotNull(), (first + (ties - F.lit(1)) / F.lit(2.0)) / n)
    return df.withColumns(cols)


def robust_z_window(df, measures, keys, mad_floor=None, z_cap=None):
    part = Window.partitionBy(*keys)
    out = df
    for name, expr in measures.items():
        x = _c(expr).cast("double")
        med_col, dev_col = f"_{name}__med", f"_{name}__dev"
        out = out.withColumn(med_col, F.median(x).over(part))
        out = out.withColumn(dev_col, F.abs(x - F.col(med_col)))
        out = out.withColumn(name, _z(x, F.col(med_col), F.median(F.col(dev_col)).over(part),
                                      mad_floor, z_cap)).drop(med_col, dev_col)
    return out
