"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections, with DataFrame functions alone.

A paragraph is a line. Its leaves are short runs of words that end where the text itself says so: at a blank, but for
those after one of a fixed set of characters, or at LEAF_CHARS characters. An edit therefore moves the bounds near it and no others.
Leaves are hashed by SHA-256; a paragraph's hash covers its leaves' hashes. A section is a run of paragraphs that ends
where a paragraph's hash ends in 0 or 8, its hash covers its paragraphs' hashes, and the root covers the sections'.
Equal roots mean equal texts, and differing branches name the sections, paragraphs and leaves edited. The fingerprint
keeps the root, the section branches and a bounded sample of the leaf branches, from which the likeness is worked out.

fingerprint = root ":" first 8 hex digits of every section ":" the SKETCH least 8-digit leaf branches, or all.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SKETCH = 64
#: Most characters of a leaf.
LEAF_CHARS = 16
#: A leaf ends at a blank or an ideographic comma or full stop, unless one of these characters stands before it.
GOES_ON = r"\x09\x0B-\x0D\x20f-rt-zF-Z5-9"
LEAF = rf"[^\n]{{0,{LEAF_CHARS - 1}}}?[^\n{GOES_ON}][\x09\x0B-\x0D\x20\x{{3001}}-\x{{3002}}\x{{FF0C}}]|[^\n]{{1,{LEAF_CHARS}}}"
#: Rows per range of ids, about, as long as no more than MOST_RANGES ranges are needed.
ROWS_PER_GROUP = 2_000
MOST_RANGES = 1 << 16
_NO_ID = -(2**63)


def leaf_hashes(text: Column) -> Column:
    """The hashes of the leaves of each paragraph."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda x: F.sha2(x, 256)))


def paragraph_hashes(leaves: Column) -> Column:
    return F.transform(leaves, lambda hs: F.sha2(F.array_join(hs, ""), 256))


def section_texts(paragraphs: Column) -> Column:
    """The paragraph hashes of each section, joined."""
    marked = F.transform(paragraphs, lambda h: F.concat(h, F.when(F.substring(h, 64, 1).isin("0", "8"), "|").otherwise("")))
    return F.filter(F.split(F.array_join(marked, ""), "\\|"), lambda s: s != "")


def section_hashes(paragraphs: Column) -> Column:
    return F.transform(section_texts(paragraphs), lambda s: F.sha2(s, 256))


def sketch(leaves: Column) -> Column:
    """Least distinct leaf branches, at most SKETCH of them, ascending."""
    return F.slice(F.sort_array(F.array_distinct(F.transform(F.flatten(leaves), lambda h: F.substring(h, 1, 8)))), 1, SKETCH)


def with_fingerprint(df: DataFrame, text: str, to: str) -> DataFrame:
    """df with one more column, the fingerprint of a text column; null text has the fingerprint of the empty text."""
    leaves, sections = f"__leaves_{to}", f"__sections_{to}"
    return (
        df.withColumn(leaves, leaf_hashes(F.coalesce(F.col(text), F.lit(""))))
        .withColumn(sections, section_hashes(paragraph_hashes(F.col(leaves))))
        .withColumn(
            to,
            F.concat_ws(
                ":",
                F.sha2(F.array_join(sections, ""), 256),
                F.array_join(F.transform(sections, lambda s: F.substring(s, 1, 8)), ""),
                F.array_join(sketch(F.col(leaves)), ""),
            ),
        )
        .drop(leaves, sections)
    )


def likeness(a: Column | str, b: Column | str) -> Column:
    """Likeness of two fingerprints, 0 to 1: 1 for equal roots, else the share of leaf branches in common (Dice), as
    estimated from the least ones of the union; exact where both texts have at most SKETCH distinct leaves."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    left, right = (F.regexp_extract_all(F.element_at(F.split(x, ":"), 3), F.lit(".{8}"), F.lit(0)) for x in (a, b))
    union = F.slice(F.sort_array(F.array_union(left, right)), 1, SKETCH)
    common, total = F.size(F.array_intersect(F.array_intersect(union, left), right)), F.size(union)
    j = common / F.greatest(total, F.lit(1))
    same = F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)
    return F.when(same, F.lit(1.0)).otherwise(2.0 * j / (1.0 + j)).cast("double")


def changed_paragraphs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """pairs with left_changed and right_changed: positions (from 0) of paragraphs whose hash is in no section branch of
    the other side. Sections equal on both sides are not descended into. Null texts count as empty."""
    l, r = (paragraph_hashes(leaf_hashes(F.coalesce(F.col(c), F.lit("")))) for c in (left, right))
    out = pairs.withColumn("__l", l).withColumn("__r", r)

    def own(one: str, other: str) -> Column:
        open_sections = F.array_except(section_texts(F.col(one)), section_texts(F.col(other)))
        return F.transform(
            F.filter(
                F.transform(F.col(one), lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
                lambda x: F.exists(open_sections, lambda s: F.contains(s, x["h"])) & ~F.array_contains(F.col(other), x["h"]),
            ),
            lambda x: x["i"],
        )

    return out.withColumn("left_changed", own("__l", "__r")).withColumn("right_changed", own("__r", "__l")).drop("__l", "__r")


def longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' if v != _NO_ID else f'({v + 1}L - 1L)' for v in values)})")


def with_groups(docs: DataFrame) -> DataFrame:
    """docs (id, tie, ...) with g, the row's range in the order of (id, tie): about ROWS_PER_GROUP rows each, whatever the ids.

    Ranges start at quantiles of the ids. An id with so many rows that several quantiles fall on it (the rows without an
    id, for one) is divided further by equal widths of tie, a hash of the text. Only the quantiles reach the driver, at
    most MOST_RANGES; beyond that, ranges grow.
    """
    ranges = min(MOST_RANGES, docs.count() // ROWS_PER_GROUP)
    if ranges < 2:
        return docs.withColumn("g", F.lit(0).cast("long"))
    shares = F.expr(f"array({', '.join(f'{k / ranges!r}D' for k in range(1, ranges))})")
    times = Counter(docs.agg(F.percentile_approx("id", shares, 4 * ranges)).first()[0])
    starts = sorted(times)
    step = int(len(starts) ** 0.5) + 1
    blocks = [starts[k : k + step] for k in range(0, len(starts), step)]
    block = F.size(F.filter(longs([b[0] for b in blocks]), lambda s: s <= F.col("id")))
    out = docs.withColumn("__block", block)
    out = out.withColumn("__in", F.when(F.col("__block") > 0, F.size(F.filter(F.element_at(F.array(*map(longs, blocks)), F.col("__block")), lambda s: s <= F.col("id")))))

    def of_range(values: list[list[int]]) -> Column:
        return F.element_at(F.element_at(F.array(*map(longs, values)), F.col("__block")), F.col("__in"))

    parts = of_range([[times[s] for s in b] for b in blocks])
    place = F.floor((F.col("tie").cast("double") / float(2**64) + 0.5) * parts)
    within = F.when(F.col("id") == of_range(blocks), F.least(place, parts - 1)).otherwise(parts - 1)
    number = ((F.col("__block") - 1) * step + F.col("__in")).cast("long") * (1 << 32) + within
    return out.withColumn("g", F.when(F.col("__block") > 0, number).otherwise(F.lit(0).cast("long"))).drop("__block", "__in")


def with_next(docs: DataFrame) -> DataFrame:
    """docs (id, tie, text, ...) with their fingerprint, and next_text and next_fingerprint of the row after by (id, tie).

    After the last comes the first. Rows meet by ranges of ids; the first row of a range is copied to the end of the
    range before, so texts move once. What is known of all ranges is one small row each, at most twice MOST_RANGES.
    """
    placed = with_groups(docs)
    firsts = placed.groupBy("g").agg(F.min(F.struct("id", "tie")).alias("head"))
    order = Window.orderBy("g")
    before = F.coalesce(F.lag("g").over(order), F.max("g").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = written(firsts.select("g", F.col("head.id").alias("id"), F.col("head.tie").alias("tie"), before.alias("to")), "range-heads")
    copies = placed.join(F.broadcast(firsts), ["g", "id", "tie"]).withColumn("g", F.col("to")).drop("to").withColumn("copy", F.lit(1))
    rows = with_fingerprint(placed.withColumn("copy", F.lit(0)).unionByName(copies), "text", "fingerprint")
    within = Window.partitionBy("g").orderBy("copy", "id", "tie")
    led = rows.withColumn("next_text", F.lead("text").over(within)).withColumn("next_fingerprint", F.lead("fingerprint").over(within))
    return led.filter("copy = 0").drop("copy", "g")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text is the text with its last floor(n_chars / 4) characters replaced by as many first ones (or all) of
    the next document. Null text: empty. Rows of one doc_id follow each other in the order of their texts' hashes, so a
    repeated row's next may be its repeat. Null ids come first. An id with very many rows is divided by the hashes of
    its texts; only rows that repeat both id and text stay in one range. A single document is its own next. Other columns are
    left out; empty input gives an empty result.
    """
    doc = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    doc = doc.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), F.xxhash64("text").alias("tie"), "text")
    led = with_next(doc).withColumn("n_chars", F.char_length("text").cast("long"))
    take = "cast(floor(n_chars / 4) as int)"
    edited = led.withColumn("edited", F.expr(f"concat(substring(text, 1, cast(n_chars as int) - {take}), substring(next_text, 1, {take}))"))
    return with_fingerprint(edited, "edited", "edited_fingerprint").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


def _sql_fingerprint(t: str) -> str:
    leaves = f"list_transform(string_split({t}, chr(10)), lambda p: list_transform(regexp_extract_all(p, '{LEAF}'), lambda x: sha256(x)))"
    paragraphs = f"list_transform({leaves}, lambda hs: sha256(coalesce(array_to_string(hs, ''), '')))"
    sections = (
        f"list_transform(list_filter(string_split(array_to_string(list_transform({paragraphs}, lambda h: h || CASE WHEN "
        f"substr(h, 64, 1) IN ('0', '8') THEN '|' ELSE '' END), ''), '|'), lambda s: s <> ''), lambda s: sha256(s))"
    )
    least = f"list_slice(list_sort(list_distinct(list_transform(flatten({leaves}), lambda h: substr(h, 1, 8)))), 1, {SKETCH})"
    return (
        f"sha256(array_to_string({sections}, '')) || ':' || array_to_string(list_transform({sections}, lambda s: substr(s, 1, 8)), '') "
        f"|| ':' || coalesce(array_to_string({least}, ''), '')"
    )


def _sql_likeness(a: str, b: str) -> str:
    left, right = (f"regexp_extract_all(split_part({x}, ':', 3), '.{{8}}')" for x in (a, b))
    union = f"list_slice(list_sort(list_distinct(list_concat({left}, {right}))), 1, {SKETCH})"
    j = f"(len(list_intersect(list_intersect({union}, {left}), {right}))::DOUBLE / greatest(len({union}), 1))"
    return f"CASE WHEN split_part({a}, ':', 1) = split_part({b}, ':', 1) THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * {j} / (1.0::DOUBLE + {j}) END"


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
o AS (SELECT doc_id, n_chars, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS nxt FROM d),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(nxt, 1, n_chars // 4) AS edited FROM o),
f AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_sql_fingerprint("text")} AS fingerprint,
  {_sql_fingerprint("edited")} AS edited_fingerprint, {_sql_fingerprint("nxt")} AS next_fingerprint FROM e)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_sql_likeness("fingerprint", "edited_fingerprint")} AS near_edited, {_sql_likeness("fingerprint", "next_fingerprint")} AS near_next
FROM f
"""
