"""Exact duplicates, near duplicates and boilerplate lines."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ridelake.llm import exact_dedup, jaccard_join, line_dedup
from ridelake.llm.components import components
from ridelake.llm.shingles import WordNumbers, shingles, tokens
from tests.llm.conftest import SF


def test_exact_dedup_awkward(awkward):
    rows = exact_dedup.deduplicate(awkward).collect()
    assert len(rows) == 9
    by = {(r.doc_id, r.group_size): r for r in rows}
    assert by[(3, 3)].keep_id == 3 and not by[(5, 3)].kept
    assert sorted(r.kept for r in rows if r.doc_id == 3 and r.group_size == 3) == [False, True]  # one of a row that repeats
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    assert by[(1, 3)].kept and not by[(2, 3)].kept and by[(2, 3)].keep_id == 1  # null counts as empty
    assert exact_dedup.deduplicate(awkward.limit(0)).count() == 0


def test_directory_doubles_and_slots_share_buckets(spark, docs):
    frame = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id % 2000) AS text")
    index = exact_dedup.build_index(frame, capacity=100)
    assert index.depth >= 5
    sizes = index.entries.groupBy("bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 100 and sum(r["count"] for r in sizes) == 2000
    assert index.directory.count() <= 2**index.depth
    rows = exact_dedup.deduplicate(frame, capacity=100)
    assert rows.where("kept").count() == 2000 and rows.where("group_size = 2").count() == 2000


def test_texts_that_share_a_key_chain(docs, monkeypatch):
    """With one key for all texts and one digest, bytes alone keep them apart."""
    def same_key(docs):
        return probes(docs).withColumn("key", F.lit(7).cast("long"))
    probes = exact_dedup.probes
    monkeypatch.setattr(exact_dedup, "probes", same_key)
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda *_: F.lit("same"))
    rows = exact_dedup.deduplicate(docs((1, "a"), (2, "b"), (3, "a"), (4, "c"), (2, "b"))).orderBy("doc_id").collect()
    assert [(r.keep_id, r.group_size, r.chain) for r in rows] == [
        (1, 2, 1), (2, 2, 2), (2, 2, 2), (1, 2, 1), (4, 1, 3)]
    assert sum(r.kept for r in rows) == 3 and {r.text_sha256 for r in rows} == {"same"}


def test_chains_among_other_keys(spark, monkeypatch):
    """Some keys collide and some do not; small buckets, so that the directory grows."""
    probes = exact_dedup.probes
    monkeypatch.setattr(exact_dedup, "probes", lambda docs: probes(docs).withColumn(
        "key", F.xxhash64(F.length("body"), F.when(F.length("body") > 6, F.col("body")))))
    frame = spark.range(4000).selectExpr("id AS doc_id", "concat('t', id % 1500) AS text").unionByName(
        spark.range(500).selectExpr("id + 5000 AS doc_id", "concat('longer ', id % 250) AS text"))
    rows = exact_dedup.deduplicate(frame, capacity=20).join(frame, "doc_id").collect()
    least, number = {}, {}
    for row in rows:
        least[row.text] = min(row.doc_id, least.get(row.text, row.doc_id))
        number[row.text] = number.get(row.text, 0) + 1
    assert len(rows) == 4500 and {(r.keep_id, r.group_size, r.kept) == (
        least[r.text], number[r.text], r.doc_id == least[r.text]) for r in rows} == {True}


def brute_links(rows):
    numbers = WordNumbers()
    sets = {i: set(shingles(numbers.of(tokens(t)), 5).tolist()) for i, t in rows}
    links = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and sets[i] and both * 9 >= 4 * (len(sets[i]) + len(sets[j])):
                links[i].add(j)
                links[j].add(i)
    return links


@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_join_equals_brute_force(docs, block):
    """Groups of near copies larger than a block, a passage that many texts share, and texts of their own."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(words) for _ in range(40)]
    rows = []
    for group in range(4):
        base = [draw.choice(words) for _ in range(120)]
        for _ in range(22 if group == 0 else 3):
            copy = base[:]
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    for _ in range(40):
        rows.append((len(rows), " ".join(passage + [draw.choice(words) for _ in range(60)])))
    expected = brute_links(rows)
    got = {r.doc_id: r for r in jaccard_join.join(docs(*rows), block_texts=block).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(x) for i, x in expected.items()}
    assert all(got[i].class_id == got[j].class_id for i, x in expected.items() for j in x)
    assert len({r.class_id for r in got.values()}) == 44 - 40 + 40 or sum(map(len, expected.values())) > 0


def test_jaccard_awkward_and_one_of_each_class(awkward):
    rows = jaccard_join.join(awkward).collect()
    assert len(rows) == 9
    three = [r for r in rows if r.doc_id == 5][0]
    assert (three.class_id, three.copies, three.n_links) == (3, 3, 2)
    kept = jaccard_join.one_of_each_class(awkward)
    assert kept.columns == awkward.columns
    texts = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect())
    assert [x[:2] for x in texts if not x[0]] == [(False, 1), (False, 3), (False, 3), (False, 4)]
    assert jaccard_join.join(awkward.limit(0)).count() == 0


def test_pruning_needs_more_matches_as_it_goes():
    fewest = jaccard_join.least_matches(0.8, 1e-4)
    assert fewest == sorted(fewest) and len(fewest) == 8 and 30 < fewest[-1] < 51


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (7, 7)] + [(300, i) for i in range(301, 340)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {found[i] for i in range(51)} == {0} and found[200] == found[100] == 100 and found[339] == 300
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lines_on_many_sites_go_and_copies_of_pages_stay(docs):
    rows = [(i, f"Own line {i} {'x' * 40}\n  Read more here \n---\nEnd {i}", f"s{i}") for i in range(10)]
    rows += [(100 + i, "Read more here", f"s{i}") for i in range(3)]     # nothing but boilerplate: a copy
    rows += [(200 + i, f"Only nine sites\nbody {i}", f"s{i}") for i in range(9)] + [(300, None), (301, "")]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs(*rows, extra=True)).collect()}
    assert len(out) == len(rows)
    assert out[4].text == f"Own line 4 {'x' * 40}\n---\nEnd 4" and out[4].n_removed == 1
    assert out[100].text == "Read more here" and (out[100].n_boilerplate, out[100].n_removed) == (1, 0)
    assert out[203].text == "Only nine sites\nbody 3" and out[300].text is None and out[301].text == ""


@pytest.mark.parametrize("share", [60, 80, 95])
def test_mostly_boilerplate_is_cut_where_own_text_is_left(docs, share):
    """However little of a document is its own, the rest goes; only what would be left without a word stays whole."""
    shared = "A passage that very many sites have in common, word for word.\nAnother one of these passages here."
    own = "x" * max(1, len(shared) * (100 - share) // share)
    rows = [(i, f"{shared}\n{own}{i}", f"s{i}") for i in range(10)] + [(90 + i, f"{shared}\n --- \n", f"s{i}") for i in range(3)]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs(*rows)).collect()}
    assert out[3].text == f"{own}{3}" and out[3].n_removed == 2
    assert out[91].text == f"{shared}\n --- \n" and (out[91].n_boilerplate, out[91].n_removed) == (2, 0)


def test_line_spread_near_the_threshold_is_exact(spark):
    """Sketches of 200 sites are off by chance; the lines within the margin are counted."""
    rows = spark.range(6 * 210).selectExpr("id AS doc_id", "concat('line ', id % 6) AS text", "id div 6 AS at")
    rows = rows.where("at < 197 + id % 6").withColumn("source", F.concat(F.lit("site"), "at"))
    found = line_dedup.boilerplate(rows, min_sites=200).collect()
    assert sorted(r.sites for r in found) == [200, 201, 202]


def test_lines_awkward(awkward):
    out = line_dedup.dedup_lines(awkward)
    assert out.count() == 9 and set(awkward.columns) <= set(out.columns)
    assert line_dedup.dedup_lines(awkward.limit(0)).count() == 0


def test_queries_equal_sql(spark):
    from ridelake.llm.queries import QUERIES
    from ridelake.llm.sql import ORACLE
    from ridelake_checks.compare import connect, difference
    duck = connect(SF)
    for name, sql in ORACLE.items():
        assert difference(QUERIES[name](spark, SF), duck, sql) is None, name
