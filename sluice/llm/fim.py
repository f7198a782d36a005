"""Fill-in-middle transformation by counted quantifiers, with DataFrame functions alone.

A text is a row of units: runs of ASCII letters, or any other single character. `regexp_count` gives their number, two
keyed hashes choose the bounds of the middle, and a pattern made for the row, with the possessive groups `unit{a}` and
`unit{b-a}`, captures prefix, middle and suffix in one match. Possessive groups never step back, so the match is linear
in the text and needs no stack, however many units it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a unit are taken possessively as well: a run is never cut.
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"


@dataclass(frozen=True)
class Forms:
    """Sentinels, and the shares (in hundredths) of texts that stay plain and of the others that put the suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain: int = 10
    suffix_first: int = 20
    seed: int = 1

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if "" in marks or any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j):
            raise ValueError("sentinels must not be empty, and none may be part of another")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def quoted(mark: str) -> str:
    """A sentinel as a literal in a replacement."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def draws(key: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers, drawn by the SHA-256 of seed and key. A null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, forms: Forms = Forms(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n (units), form ('plain', 'psm' or 'spm'), output, prefix_chars and middle_chars (null if plain).

    Null text counts as empty; an empty text, one that holds a sentinel and a share of the others stay plain. Rows that
    repeat a key and its text repeat the result. Columns of docs that have one of the new names are replaced. Whole texts are
    cut, whatever their length.
    """
    known = F.coalesce(F.col(text).cast("string"), F.lit(""))
    made = {c.lower() for c in ("n", "form", "output", "prefix_chars", "middle_chars")} - {key.lower(), text.lower()}
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]).withColumn("__text", known)
    h1, h2, h3, h4 = draws(F.col(key), forms.seed)
    out = out.withColumn("n", F.regexp_count("__text", F.lit(UNIT)).cast("long"))
    marked = F.lit(False)
    for mark in forms.marks:
        marked = marked | F.contains("__text", F.lit(mark))
    plain = (F.col("n") == 0) | marked | (h3 % 100 >= 100 - forms.plain)
    out = out.withColumn("form", F.when(plain, "plain").when(h4 % 100 < forms.suffix_first, "spm").otherwise("psm"))
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    pattern = F.format_string(
        f"(?s)\\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*+)\\z", F.least(one, two), F.abs(one - two)
    )
    p, s, m = map(quoted, forms.marks)
    order = F.when(F.col("form") == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    out = out.withColumn("output", F.when(F.col("form") == "plain", F.col("__text")).otherwise(F.regexp_replace("__text", pattern, order)))

    def place(mark: str) -> Column:
        return F.locate(mark, F.col("output"))

    after = F.when(F.col("form") == "psm", place(forms.suffix)).otherwise(place(forms.middle))
    prefix = after - place(forms.prefix) - len(forms.prefix)
    middle = F.char_length("output") - place(forms.middle) - len(forms.middle) + 1
    return (
        out.withColumn("prefix_chars", F.when(F.col("form") != "plain", prefix.cast("long")))
        .withColumn("middle_chars", F.when(F.col("form") != "plain", middle.cast("long")))
        .drop("__text")
    )


def restored(output: Column, form: Column, forms: Forms = Forms()) -> Column:
    """The text that an output was made from, by its form."""

    def between(left: str, right: str | None) -> Column:
        rest = F.substr(output, F.locate(left, output) + len(left))
        return rest if right is None else F.substring_index(rest, right, 1)

    p, s, m = forms.marks
    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def cut_and_restore(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every row, whole texts."""
    out = transform(docs.select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
