"""Source divergence audit: how far the word use of each source lies from that of the others of its language.

Identical texts of a language are collapsed to one row with their number in each source, each is split into terms once,
and document frequencies and counts are added with those weights. Pairs of sources are evaluated on the terms that
either of them has: a term that both lack adds the same to every pair, so it enters by a product. All values are integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.ship import ship
from .common import slices, written

#: A language keeps terms that at least so many of its documents hold.
LEAST_DOCUMENTS = 30
#: Terms reported per group.
TOP_TERMS = 50
#: Shares are in units of one over SCALE, counts are raised by PSEUDO.
SCALE, PSEUDO = 1_000_000_000, 5
#: Partial counts that a task holds before it hands them on.
HELD_COUNTS = 400_000
#: Terms and sources of one block of pair evaluation.
BLOCK_TERMS, BLOCK_SOURCES = 512, 128

#: ASCII letters to lower case, other ASCII to blanks; bytes of longer characters stay.
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters of UTF-8 text, A to Z in lower case."""
    return text.translate(_FOLD).split(b" ")


def known(docs: DataFrame) -> DataFrame:
    """lang, source, text of docs, nulls as empty."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies array<(source, n)>) of the distinct texts of each language, which are told by their SHA-256.

    Copies are counted and texts made distinct before anything moves, so a text that fills a third of the rows is one row
    of each task. Texts move once; the numbers of their copies meet them where they are.
    """
    rows = known(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("digest", "lang", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("digest", "lang").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("digest", "lang").agg(F.any_value("text").alias("text"))
    return texts.join(copies, ["digest", "lang"]).drop("digest")


def partial_counts(texts: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): counts and document frequencies by source, with the multiplicities of each text.
    A task adds up what it can hold; sums over tasks are the reader's."""
    ship(texts.sparkSession)

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for part in slices([batch]):
                columns = (part.column(c).to_pylist() for c in ("lang", "text", "copies"))
                for lang, text, copies in zip(*columns):
                    found = Counter(terms_of(text))
                    found.pop(b"", None)
                    for c in copies:
                        (counts, documents), n = held[lang, c["source"]], c["n"]
                        if n == 1:
                            counts.update(found)
                            documents.update(found.keys())
                        else:
                            for term, k in found.items():
                                counts[term] += k * n
                                documents[term] += n
                if sum(len(counts) for counts, _ in held.values()) > HELD_COUNTS:
                    yield from rows(held)
                    held.clear()
        yield from rows(held)

    def rows(held):
        for (lang, source), (counts, documents) in held.items():
            if counts:
                k = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                        pa.array(counts.values(), pa.int64()), pa.array(map(documents.__getitem__, counts), pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "documents"],
                )

    schema = "lang string, source string, term string, n long, documents long"
    return texts.select("lang", F.col("text").cast("binary").alias("text"), "copies").mapInArrow(run, schema)


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, sources array<(source, n)>) of the terms that at least `least` documents of the language hold.

    Tasks have added up their counts, so these move once, by term, for the sums by source and those by language.
    """
    per_source = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    found = per_source.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return found.filter(F.col("documents") >= least).select("lang", "term", "total", "sources")


def share(count: Column | int, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + PSEUDO) / (total + PSEUDO * kept)) in exact decimals."""
    wide = "decimal(38,0)"
    count = F.lit(count) if isinstance(count, int) else count
    return (F.expr("1L") + F.call_function("div", (F.lit(SCALE).cast("decimal(10,0)") * (count + PSEUDO).cast("decimal(20,0)")).cast(wide), (F.col(total).cast("decimal(20,0)") + (F.col(kept) * PSEUDO).cast("decimal(20,0)")).cast(wide)))


def pair_sums(counts: DataFrame, groups: DataFrame, languages: DataFrame) -> DataFrame:
    """(lang, a, b, excess) for a < b: the sum over the terms that a or b holds of |p_a - p_b| - |z_a - z_b|, where z is
    the share of a term without counts.

    Sources are dealt into blocks of about BLOCK_SOURCES and terms into blocks of about BLOCK_TERMS by their hashes. A task
    holds the shares of two blocks of sources for one block of terms and gives one row per pair, whatever the number of
    terms, so no row is made for each pair of a term.
    """
    sized = languages.select(
        "lang", F.ceil(F.col("v") / BLOCK_TERMS).cast("int").alias("term_blocks"), F.ceil(F.col("groups") / BLOCK_SOURCES).cast("int").alias("source_blocks")
    ).filter("term_blocks > 0")
    block = F.pmod(F.xxhash64("source"), F.col("source_blocks")).cast("int")

    def placed(rows: DataFrame) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1))
        tiles = rows.withColumn("own", block).withColumn("other", other)
        return tiles.select("lang", "term_block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("k"), "own", "source", "term", "p", "z")

    filled = counts.join(sized, "lang").withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
    empty = (
        groups.join(sized, "lang").withColumn("term_block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
        .withColumn("term", F.lit(None).cast("string")).withColumn("p", F.col("z"))
    )
    ship(counts.sparkSession)

    def evaluate(part: pd.DataFrame) -> pd.DataFrame:
        own = part[part["term"].isna()].drop_duplicates("source").sort_values("source")
        names, zero, blocks = own["source"].tolist(), own["z"].to_numpy(np.int64), own["own"].to_numpy()
        held = part[part["term"].notna()]
        row = pd.Series(range(len(names)), index=names)
        column, seen = pd.factorize(held["term"])
        shares = np.repeat(zero[:, None], len(seen), axis=1)
        shares[row[held["source"]].to_numpy() if len(held) else [], column] = held["p"].to_numpy(np.int64)
        i, k = int(part["i"].iloc[0]), int(part["k"].iloc[0])
        left, right, excess = [], [], []
        for a in range(len(names)):
            later = np.arange(a + 1, len(names))
            if i != k:
                later = later[blocks[later] != blocks[a]]  # pairs of one block are evaluated in that block's own tile
            if len(later):
                apart = np.abs(shares[later] - shares[a]).sum(axis=1) - len(seen) * np.abs(zero[later] - zero[a])
                left += [names[a]] * len(later)
                right += [names[x] for x in later]
                excess += apart.tolist()
        lang = np.full(len(left), part["lang"].iloc[0], object)
        return pd.DataFrame({"lang": lang, "a": np.array(left, object), "b": np.array(right, object), "excess": np.array(excess, np.int64)})

    tiles = placed(filled).unionByName(placed(empty)).groupBy("lang", "term_block", "i", "k")
    parts = tiles.applyInPandas(evaluate, "lang string, a string, b string, excess long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("excess").alias("excess"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank. Part 'pair': value is the distance of the source to each other source of its
    language over all kept terms. Part 'term': the `top` terms whose share in the source most exceeds that in the language.

    Null text, language and source count as empty; groups without terms, repeated rows and languages that keep no term (distance 0)
    are included; a language of one source has no pair. Ties rank by item. Other columns are ignored. An empty table gives
    no row. The rows of part 'pair' grow with the square of a language's sources, as they are its result.
    """
    kept = written(kept_terms(partial_counts(collapsed(docs)), least), "kept-terms")
    occurring = known(docs).select("lang", "source").distinct()
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    per_source = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("group_n"))
    groups = (
        occurring.join(per_source, ["lang", "source"], "left").join(totals, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("group_n", "v", "lang_n")])
    )
    groups = written(groups.withColumn("z", F.when(F.col("v") > 0, share(0, "group_n", "v"))), "groups")
    languages = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"), F.max("v").alias("v"))
    flat = kept.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "term", "total", "s.source", "s.n")
    counts = flat.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "z", share(F.col("n"), "group_n", "v").alias("p"), share(F.col("total"), "lang_n", "v").alias("q")
    )

    value = F.col("value").desc()
    more = counts.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_group = Window.partitionBy("lang", "source", "part")
    terms = more.withColumn("rank", F.row_number().over(by_group.orderBy(value, "item"))).filter(F.col("rank") <= top)

    sums = pair_sums(counts.select("lang", "source", "term", "p", "z"), groups, languages)
    ends = groups.select("lang", "source", "v", "z")
    both = ends.join(ends.select("lang", F.col("source").alias("item"), F.col("z").alias("other")), "lang").filter("source <> item")
    both = both.withColumn("a", F.least("source", "item")).withColumn("b", F.greatest("source", "item"))
    value_of = F.coalesce(F.col("v") * F.abs(F.col("z") - F.col("other")) + F.coalesce("excess", F.lit(0)), F.lit(0)).cast("long")
    pairs = both.join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value_of.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_group.orderBy(value, "item")))
    return pairs.unionByName(terms)


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
u AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM u GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM u SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS lang_n FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n, coalesce(group_n, 0) AS group_n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS group_n FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, (1 + {SCALE}::HUGEINT * (coalesce(n, 0) + {PSEUDO}) // (group_n + {PSEUDO} * v))::BIGINT AS p,
  (1 + {SCALE}::HUGEINT * (total + {PSEUDO}) // (lang_n + {PSEUDO} * v))::BIGINT AS q FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
