"""Filter audit, importance resampling and packing."""

from __future__ import annotations

import random
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import filter_audit, importance_resampling, packing
from ridelake.llm.shared import benchmark, documents
from tests.llm.conftest import LONG, SF


def brute_bits(rows):
    """doc_id, part and bits by comparing every row with every other."""
    out = []
    for number, text, source in rows:
        words = [w for w in (text or "").replace("\n", " ").split(" ") if w]
        bits = (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
        bits += 4 * (100 * sum("A" <= c <= "Z" for c in text or "") > 5 * len(text or ""))
        bits += 8 * any(c in "#$%&*|" for c in text or "")
        bits += 16 * any(number is not None and i is not None and i < number and (t or "") == (text or "") for i, t, _ in rows)
        out.append((number, source or "", bits))
    return out


def awkward_rows():
    draw = random.Random(5)
    texts = ["", None, "a", "ab", "abc", "é" * 30, "é" * 29 + "e", "HELLO # there", LONG, LONG + " end"]
    texts += ["shared start of many texts " * 3 + str(draw.randrange(40)) for _ in range(60)]
    texts += [" ".join(draw.choice("abcdefgh") for _ in range(70)) for _ in range(5)] * 2
    rows = [(draw.randrange(60), text, draw.choice(["x", "y", None])) for text in texts * 2]
    return [*rows, rows[0], (None, "a", "x"), (None, "a", "z")]


@pytest.mark.parametrize("options", [{}, {"range_bytes": 200, "held_bytes": 100, "most_partitions": 3}])
def test_copies_in_tries_equal_brute_force(docs, options):
    """Also with ranges of a few texts, several to a partition, and with texts that share long prefixes."""
    rows = awkward_rows()
    found = filter_audit.failures(docs(*rows, extra=True), **options).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1], row[2])
    assert sorted(map(tuple, found), key=key) == sorted(brute_bits(rows), key=key)


def test_prefixes_adapt(spark):
    """Ranges are about equal although all texts share their first hundred characters, and copies weigh once."""
    texts = spark.range(4000).selectExpr("concat(repeat('p', 100), sha2(string(id % 1000), 256)) AS body")
    bounds = filter_audit.prefix_ranges(texts, 16_400)
    assert 8 <= len(bounds) <= 12 and bounds == sorted(set(bounds))
    assert filter_audit.prefix_ranges(texts.limit(0)) == []


def test_trie_is_compressed():
    trie = filter_audit.Trie()
    for number, text in enumerate([b"romane", b"romanus", b"romulus", b"rom", b"", b"romane", b"romane", b""]):
        trie.insert(text, number, number)
    assert sum(map(len, trie.edge)) == len(b"rom" b"an" b"e" b"us" b"ulus")
    assert dict(trie.copies()) == {filter_audit.digest_of(b"romane"): 0, filter_audit.digest_of(b""): 4}


def test_audit_equals_applying_the_filters(spark, docs):
    rows = awkward_rows()
    marks = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(0, 1, None), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(docs(*rows), labels).collect()}
    good, toxic = {0} | {i for i, q, _ in marks if q == 1}, {i for i, _, t in marks if t == 1}
    assert len(got) == 4 * 600
    for part in ("x", "y", "z", ""):
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = [(i, b) for i, p, b in brute_bits(rows) if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                out = [(i, b) for i, b in left if b & bit]
                r = got[part, order, step]
                left = [(i, b) for i, b in left if not b & bit]
                assert (r.kept, r.removed, r.redundant) == (len(left), len(out), sum(1 for _, b in gone if b & bit))
                assert r.good_lost == sum(i is not None and i in good for i, _ in out)
                assert r.toxic_lost == sum(i is not None and i in toxic for i, _ in out)
                gone += out
                shapley[letter] += len(out)
        assert all(r.shapley == shapley[o[s - 1]] for (p, o, s), r in got.items() if p == part)
    assert filter_audit.audit(docs(*rows).limit(0), labels).count() == 0
    assert filter_audit.audit(docs(*rows), labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_words_and_buckets():
    assert importance_resampling.words_of("Ünder-SCORE_9 é x\x7fy") == ["Ünder".encode(), b"score", b"9", "é".encode(), b"x", b"y"]
    assert importance_resampling.features_of("a b c", 2) == [b"a", b"b", b"c", b"a b", b"b c"]
    assert importance_resampling.Buckets(10_000)[b"abc"] == zlib.crc32(b"abc") % 10_000


def test_ranks_equal_sorting(spark):
    """A third of the rows are one row, ids are null or shared, scores tie; many more segments than needed."""
    draw = random.Random(2)
    rows = [(draw.choice([None, *range(40)]), 30, 30, 0, draw.randrange(-20, 20)) for _ in range(600)]
    rows += [(7, 30, 30, 0, 5)] * 300 + [(draw.randrange(900), n, n, 0, 99) for n in (0, 5, 19)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(7)
    got = importance_resampling.draw(frame, segments=13, most_samples=200).collect()
    able = sorted((-r[4], r[0] is None, r[0] or 0) for r in rows if r[1] >= 20)
    drawn = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["rank"])
    assert [d[0] for d in drawn] == list(range(1, 91)) and [d[1:] for d in drawn] == able[:90]
    assert len(got) == len(rows)


def test_segments_are_even(spark):
    """Splitters from regular samples of sorted runs bound every segment, though a third of the rows are equal."""
    scored = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 1, id) AS doc_id", "IF(id % 3 = 0, 5, id % 71) AS score", "id AS n").repartition(6)
    runs = scored.sortWithinPartitions(F.desc("score"), "doc_id").withColumn("place", F.monotonically_increasing_id()).cache()
    keys = importance_resampling.regular_splitters(runs, 9000, 10, 900)
    at = runs.toPandas()
    own = importance_resampling._keys(at["score"].to_numpy(), at["doc_id"].to_numpy(), np.zeros(9000, bool), at["place"].to_numpy())
    sizes = np.bincount(np.searchsorted(keys, own, "right"), minlength=10)
    assert sizes.sum() == 9000 and sizes.max() <= 900 + 6 * 10


def test_resampling_awkward(awkward, spark):
    target = spark.createDataFrame([(1, "word1x1 word2x2"), (2, None)], "item_id long, text string")
    rows = importance_resampling.resample(awkward, target).collect()
    assert len(rows) == 9 and {(r.n_features, r.weight) for r in rows if r.doc_id in (1, 2)} == {(0, 0)}
    assert [r["rank"] for r in rows if r["rank"]] == []  # a tenth of one document
    assert importance_resampling.resample(awkward.limit(0), target).count() == 0
    assert importance_resampling.resample(awkward, target.limit(0)).count() == 9


def histogram(lengths):
    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    np.add.at(counts, lengths, 1)
    return counts


@pytest.mark.parametrize("small, groups", [(packing.SMALL, packing.GROUPS), (100, 20)])
@pytest.mark.parametrize("n", [0, 1, 40, 5000, 10**9])
def test_plan_places_every_piece_once(n, small, groups):
    draw = np.random.default_rng(n)
    lengths = np.clip(draw.lognormal(6, 1, min(n, 5000)), 1, 2047).astype(np.int64)
    counts = histogram(lengths) * max(1, n // 5000)
    plan = packing.plan(counts, small, groups)
    tokens = int((counts * np.arange(len(counts))).sum())
    assert plan.sequences >= -(-tokens // packing.CAPACITY)
    if small == packing.SMALL and n >= 5000:
        assert plan.sequences <= 1.01 * tokens / packing.CAPACITY + 1
    if n <= 5000:
        length = np.repeat(np.arange(len(counts)), counts)
        rank = np.concatenate([np.arange(c) for c in counts])
        sequence, offset = plan.places(length, rank)
        order = np.lexsort((offset, sequence))
        sequence, offset, length = sequence[order], offset[order], length[order]
        fresh = np.diff(sequence, prepend=-1) > 0
        ends = offset + length
        assert (offset[fresh] == 0).all() and (offset[~fresh] == ends[:-1][~fresh[1:]]).all()
        assert (ends <= packing.CAPACITY).all() and len(set(sequence.tolist())) == plan.sequences
    else:  # the runs of a length are as long as it has pieces
        assert set(plan.length.tolist()) == set(np.flatnonzero(counts).tolist())


def test_configurations_solve_a_small_case():
    """Sizes 6, 5, 4 in sequences of 10: six and four, five and five."""
    used = packing.configurations(np.array([6, 5, 4]), np.array([8, 6, 8]), 10)
    assert sum(n for _, n in used) == 11 and sum(held * n for held, n in used).tolist() == [8, 6, 8]


def check_packing(docs_frame, rows, expected):
    """Gapless sequences within the capacity, every document whole, checksums and ids those of the tokenizer."""
    by, places = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert set(by) == set(expected)
    for number, ids in expected.items():
        at = 0
        for i, r in enumerate(sorted(by[number], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == packing.CAPACITY)
            own = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert zlib.crc32(own) == r.ids_crc32
            at += r.length
        assert at == len(ids)


def test_packing_of_all_documents(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    docs = documents(spark, SF)
    extra = spark.createDataFrame([(10**6, "ends <|endoftext|> inside  \r\n\t x", "", "", 1), (10**6 + 1, None, "", "", 1),
                                   (10**6 + 2, LONG, "", "", 1)], docs.schema)
    docs = docs.union(extra)
    rows = packing.report(docs).collect()
    expected = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    check_packing(docs, rows, expected)
    tokens = sum(map(len, expected.values()))
    assert len({r.sequence_id for r in rows}) <= 1.02 * tokens / packing.CAPACITY + 1


def test_packing_awkward_and_sequences(awkward):
    packed = packing.pack(awkward)
    rows = packed.collect()
    assert sum(r.piece == 0 for r in rows) == 9
    built = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in rows:
        held = built[r.sequence_id].ids
        assert held[4 * r.offset:4 * (r.offset + r.length)] == r.ids and len(held) <= 4 * packing.CAPACITY
    assert packing.report(awkward.limit(0)).count() == 0


def test_packing_reads_benchmark_texts(spark):
    items = benchmark(spark, SF).selectExpr("item_id AS doc_id", "text")
    assert packing.pack(items).where("piece = 0").count() == items.count()
