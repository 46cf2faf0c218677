"""Operators that SQL can't express, against libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import EDGES, SF, by_id, frame, given
from larder.llm import best_fit, chunk_dedup, cross_polytope, jaccard_join, orc_tokens, piece_codec, token_counts
from larder.llm.queries import QUERIES
from larder.llm.token_ids import encoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = ["a", "b", "The", "  ", " ", "é", "ﬁ", "Ⅷ", "㌔", "　", "\t", "\n", "漢", "😀", "1", "!", "'s", "\x85",
            "\xa0", "\x1c", "​", "\x01", "가", "<|endoftext|>", " "]


def noise(n, seed=1, size=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_twin_vocabulary_gives_the_same_ids(library):
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}b1{c} {c}{c}!{c}'s  {c} x" for c in points] + noise(3000)
    to_ids = encoder(BYTES)
    for t, e in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert to_ids(t).tolist() == e.ids, t


def test_runs_of_white_space_that_the_twin_refuses(spark, library):
    texts = ["a" + " " * 1_500_000 + "b", "\n" * 1_500_000, "word " * 30_000 + "\n" * 1_500_000 + "<|endoftext|> end"]
    want = [np.array(e.ids, "<u4") for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    to_ids = encoder(BYTES)
    for t, ids in zip(texts, want):
        assert np.array_equal(to_ids(t), ids)
    rows = frame(spark, [*enumerate(texts), (3, "short")])
    lengths = {}
    for r in best_fit.pack(rows).collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert [lengths[i] for i in range(3)] == [len(ids) + 1 for ids in want] and 3 in lengths
    folder = orc_tokens.new_folder(spark, "white-orc")
    written = by_id(orc_tokens.read_back(spark, orc_tokens.write_tokens(rows, folder)))
    assert [r["ids_crc32"] for r in written[:3]] == [
        zlib.crc32(np.append(ids, np.uint32(0)).tobytes()) for ids in want]


def test_counts_at_safe_boundaries(library):
    texts = noise(2000, 2) + ["x" * 70_000 + " y", "word " * 40_000, "\n" * 70_000]
    assert token_counts.PieceCounter(BYTES, 500).counts(texts) == [
        len(e) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert all("".join(token_counts.segments(t, 50)) == t for t in texts)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.PieceCounter(PIECES).counts(texts[:100]) == [len(model.encode(t)) for t in texts[:100]]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("trim", [False, True])
def test_character_map_and_alignment(rule, trim):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                                remove_extra_whitespaces=trim)
    own = piece_codec.Normaliser(dict(piece_codec.fields(lib.serialized_model_proto())).get(3, b""))
    for t in noise(600, 3, 30):
        want, offsets = lib.normalize(t, with_offsets=True)
        got, source = own(t.encode())
        at = np.cumsum([0, *(len(c.encode()) for c in got.decode())])
        assert got.decode() == want
        assert [len(t.encode()[:s].decode()) for s in source[at]] == list(offsets)


def test_pieces_cover_the_source(spark):
    texts = noise(300, 4) + [t for _, t in given()[:100]]
    rows = frame(spark, list(enumerate(texts)))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in piece_codec.encode_documents(rows).collect():
        t = texts[r["doc_id"]]
        assert r["ids"] == model.encode(t, add_eos=True) and r["decoded"] == model.decode(r["ids"])
        spans = list(zip(r["span_begin"], r["span_end"]))
        assert all(a <= b for a, b in spans) and all(x[1] <= y[1] and x[0] <= y[0] for x, y in zip(spans, spans[1:]))
        if t:
            assert spans[0][0] == 0 and spans[-1][1] == len(t.encode())
        for p, (a, b) in zip(model.encode(t, return_type="proto").pieces, spans):
            if not model.is_byte(p.id):
                assert (p.begin, p.end) == (a, b)


def test_packing_places_every_piece(spark, library):
    got = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    sequences = {}
    docs = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for i, t in given():
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for k, r in enumerate(sorted(docs.pop(i), key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not docs
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 1024) * 1.01 + 1


def test_plans_hold_their_counts():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 1025, 5000), rng.integers(300, 520, 5000), np.full(999, 1024), np.ones(5000, int), []):
        counts = dict(zip(*(x.tolist() for x in np.unique(np.asarray(lengths, int), return_counts=True))))
        plan = best_fit.best_plan(counts, 1024)
        back = {}
        for row, times in plan:
            assert sum(row) <= 1024
            for x in row:
                back[x] = back.get(x, 0) + times
        assert back == counts


def test_configurations_solve_the_programme():
    rng = np.random.default_rng(4)
    for sizes in ([512, 341, 200], sorted(rng.choice(np.arange(130, 1000), 40, replace=False).tolist())):
        wanted = rng.integers(200, 900, len(sizes)).tolist()
        found = best_fit.configurations(sizes, wanted, 1024)
        held = {x: 0 for x in sizes}
        for config, times in found:
            assert sum(config) <= 1024 and times > 0
            for x in config:
                held[x] += times
        assert all(held[x] <= n for x, n in zip(sizes, wanted))
        # what rounding down leaves over is less than one sequence for each size
        rest = sum((n - held[x]) * x for x, n in zip(sizes, wanted))
        assert rest <= 1024 * len(sizes)
    # 3 halves fill 1.5 sequences, 6 thirds 2: no configuration is better than full
    assert sum(t for _, t in best_fit.configurations([341, 512], [600, 300], 1024)) == 350


def test_lengths_are_rounded_within_groups():
    rng = np.random.default_rng(5)
    counts = dict(zip(*(x.tolist() for x in np.unique(rng.integers(1, 1025, 20_000), return_counts=True))))
    large = {x: n for x, n in counts.items() if 128 < x < 1024}
    groups = best_fit.grouped(large, best_fit.GROUPS)
    assert len(groups) <= best_fit.GROUPS + 1 < len(large) and sorted(sum(groups, [])) == sorted(large)
    plan = best_fit.best_plan(counts, 1024)
    assert sum(n for _, n in plan) <= 1.02 * sum(x * n for x, n in counts.items()) / 1024


def test_orc_stream(spark, library):
    folder = orc_tokens.new_folder(spark, "orc")
    orc_tokens.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), folder)
    rows = by_id(orc_tokens.read_back(spark, folder))
    at = 0
    for (i, t), r in zip(sorted(given()), rows):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert r == {"doc_id": i, "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        at += len(ids)
    found = orc_tokens.lookup(spark, folder, [3, 900])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert {r["doc_id"] for r in found.collect()} == {3, 900}


def test_long_passages_go_and_short_ones_stay(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages, short = [fresh(60) for _ in range(40)], [fresh(15) for _ in range(40)]
    texts = [f"{fresh(rnd.randint(5, 200))} {p} {fresh(rnd.randint(0, 90))}" for p in passages for _ in range(4)]
    texts += [f"{fresh(100)} {s} {fresh(100)}" for s in short for _ in range(3)]
    got = by_id(chunk_dedup.dedup_substrings(frame(spark, list(enumerate(texts)))))
    for k, p in enumerate(passages):
        first, *later = got[4 * k:4 * k + 4]
        assert first["text"] == texts[4 * k] and not first["dropped"]
        for r in later:
            left = sum(w in set(r["text"].split()) for w in p.split())
            assert r["dropped"] and left <= 32, (k, left)
    assert all(r["text"] == texts[r["doc_id"]] for r in got[160:])
    for r in got:                                          # spans and texts agree
        data, cut = texts[r["doc_id"]].encode(), 0
        kept = b""
        for s in r["dropped"]:
            kept, cut = kept + data[cut:s["begin"]], s["end"]
        assert (kept + data[cut:]).decode() == r["text"]


def test_passages_of_51_words_go(spark):
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(51) for _ in range(2000)]
    texts = [f"{fresh(rnd.randint(5, 40))} {p} {fresh(rnd.randint(5, 40))}" for p in passages for _ in range(2)]
    got = by_id(chunk_dedup.dedup_substrings(frame(spark, list(enumerate(texts)))))
    for first, later in zip(got[::2], got[1::2]):
        assert not first["dropped"] and later["n_dropped_words"] >= 28
        assert later["n_dropped_words"] <= 53 and later["n_dropped_chunks"] <= later["n_chunks"]


def test_rows_without_an_id_and_rows_of_one_id(spark):
    text = " ".join(f"w{k * k}" for k in range(90))
    rows = [(None, text), (-3, text), (7, f"before {text}"), (7, f"{text} after"), (None, None), (9, None)]
    got = [(r["doc_id"], r["text"], r["n_dropped_words"]) for r in chunk_dedup.dedup_substrings(frame(spark, rows)).collect()]
    assert len(got) == 6 and got.count((None, text, 0)) == 1 and (-3, text, 0) in got
    assert got.count((None, None, 0)) == 1 and (9, None, 0) in got
    assert all(t != text and n >= 80 for i, t, n in got if i == 7)


def test_repeated_phrases_of_no_common_passage_stay(spark):
    rnd = random.Random(8)
    phrase = lambda n: " ".join(rnd.choice(["ab", "cde", "f", "ghij", "kl", "mno"]) for _ in range(n))
    texts = [phrase(2000) for _ in range(40)]
    passage = "one place where sixty words of an earlier document stand again ".split() + phrase(49).split()
    texts += [" ".join([phrase(500), *passage, phrase(500)]) for _ in range(2)]
    owner, recur = set(), 0
    for t in texts[:40]:                                   # between one cut and the next, much of this recurs
        words, at = t.split(), 0
        for n in chunk_dedup.word_pieces(t.encode())[1].tolist():
            recur += tuple(words[at:at + n]) in owner
            owner.add(tuple(words[at:at + n]))
            at += n
    assert recur > 10_000
    got = by_id(chunk_dedup.dedup_substrings(frame(spark, list(enumerate(texts)))))
    assert all(r["text"] == texts[r["doc_id"]] and not r["dropped"] for r in got[:41])
    assert 28 <= got[41]["n_dropped_words"] <= 62


def test_cut_points_resist_insertions():
    text = " ".join(f"w{(i * 7919) % 1009}" for i in range(3000)).encode()
    moved = b"some inserted words " + text
    a, b = ({tuple(d) for d in chunk_dedup.chunks(t, chunk_dedup.word_pieces(t)[1])[2].tolist()} for t in (text, moved))
    assert len(a) > 500 and len(a - b) <= 4


def test_links_of_a_large_group_of_near_copies(spark):
    rnd = random.Random(3)
    base = [f"t{rnd.randint(0, 10_000)}" for _ in range(150)]
    texts = []
    for _ in range(700):
        own = list(base)
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(150)] = f"x{rnd.randint(0, 10 ** 6)}"
        texts.append(" ".join(own))
    texts += [" ".join(f"u{rnd.randint(0, 10 ** 6)}" for _ in range(60)) for _ in range(100)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    want = [sum(5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    got = by_id(jaccard_join.jaccard_join(frame(spark, list(enumerate(texts))), bucket_rows=40, block_rows=64))
    missed = sum(w - r["n_links"] for w, r in zip(want, got))
    assert all(r["n_links"] <= w for w, r in zip(want, got)) and missed <= 0.001 * sum(want)
    assert {r["class_id"] for r in got[:700]} == {0} and [r["class_id"] for r in got[700:]] == list(range(700, 800))


def test_recall_against_brute_force(spark):
    vectors = given(SF, "embeddings", "vec_id, embedding")
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], np.float64)
    found, scores = {}, {}
    for r in QUERIES["op10_nearest_neighbours"](spark, SF).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        scores[r["query_id"], r["vec_id"]] = r["score"]
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        best = [i for _, i in sorted(zip(d, ids)) if i != q][:10]
        own = [i for _, i in sorted(found[q])]
        assert len(own) == 10 and all(scores[q, i] == d[ids == i][0] for i in own)
        hits += len(set(best) & set(own))
    assert hits >= 0.9 * 10 * len(found)
