"""Source divergence: the SQL twin, a brute force in plain integers, blocks of any size, edge cases."""

import re
from collections import Counter, defaultdict

import pytest

from compare import database, same
from sluice.llm import divergence
from sluice.llm.queries import op13_source_divergence

DOCS = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, top):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        documents[lang or ""].update(set(found))
    out = []
    share = lambda c, n, v: 1 + 1_000_000_000 * (c + 5) // (n + 5 * v)
    for lang, df in documents.items():
        kept = [t for t, n in df.items() if n >= least]
        sources = [s for la, s in counts if la == lang]
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        total, v = sum(n.values()), len(kept)
        p = {s: {t: share(counts[lang, s][t], n[s], v) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), total, v) for t in kept}
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item, -value, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (value, _, item) in enumerate(found)]
    return sorted(out)


def run(spark, rows, least, top=50):
    got = divergence.audit(spark.createDataFrame(rows, DOCS), least, top)
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in got.collect())


def test_op13_equals_its_sql(spark, sf):
    same(op13_source_divergence(spark, sf), database(sf), divergence.ORACLE_SQL)


def test_all_documents_by_hand(spark, sf):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert run(spark, rows, 30) == by_hand(rows, 30, 50)


@pytest.mark.parametrize("sources, terms, held", [(1, 1, 1), (2, 3, 10), (3, 1000, 100)])
def test_blocks_of_any_size_give_the_same(spark, monkeypatch, sources, terms, held):
    for name, value in (("BLOCK_SOURCES", sources), ("BLOCK_TERMS", terms), ("HELD_COUNTS", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = [(k, f"w{chr(97 + k % 5)} common x{chr(97 + k % 11)} Ärger", "ab"[k % 2], f"s{k % 7}") for k in range(200)]
    rows += [(k, "a very common copy", "a", f"s{k % 3}") for k in range(300)]  # one text fills more than half
    assert run(spark, rows, 5, 3) == by_hand(rows, 5, 3)


def test_edges(spark):
    rows = [
        (1, None, None, None), (2, "", "", "x"), (3, "Zoë zoË ÉÉ a1b_c\x7f d", "en", "x"), (3, "Zoë zoË ÉÉ a1b_c\x7f d", "en", "x"), (4, "same same", "en", "y"),
        (5, "same other", "en", "z"), (6, "1234 !!", "en", "w"), (7, "alone", "fr", "x"), (8, "ß" * 100_000 + " b" * 100_000, "en", "y"), (9, "b", "en", None), (10, "B", "en", "😀"),
    ]
    for least in (1, 2, 30):
        assert run(spark, rows, least) == by_hand(rows, least, 50)
    assert run(spark, rows[:1], 1) == [] and divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_ties_and_clashing_columns(spark):
    rows = [(k, "one two three", "en", f"s{k}") for k in range(4)]
    df = spark.createDataFrame([r + (1, "v") for r in rows], DOCS + ", n long, term string")
    got = divergence.audit(df, 1).filter("source = 's2' AND part = 'pair'").orderBy("rank").collect()
    assert [(r.item, r.value, r["rank"]) for r in got] == [("s0", 0, 1), ("s1", 0, 2), ("s3", 0, 3)]


def test_large_counts_stay_exact(spark):
    found = spark.createDataFrame([(10**16, 10**17, 10**6)], "c long, n long, v long").select(divergence.share(divergence.F.col("c"), "n", "v").alias("p")).first().p
    assert found == 1 + 1_000_000_000 * (10**16 + 5) // (10**17 + 5 * 10**6)
