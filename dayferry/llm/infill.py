"""Fill-in-middle transformation by counted quantifiers.

A text is a row of units: white space with the word after it, or white space at the end. ``regexp_count``
gives their number n. Two hashes of the id choose the cuts a <= b in 0..n, and every row gets a pattern of
its own, ``unit{a}`` and ``unit{b-a}`` as possessive groups and the rest, so that one match captures
prefix, middle and suffix and one replacement writes them in the order of the form. Possessive
groups are matched in a loop without a way back, so long texts need no deep stack. All of it is built-in
functions in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.llm.text import packed, unpacked

UNIT = r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"


@dataclass(frozen=True)
class Marks:
    """What stands before the parts; none may be part of another or start with another's end."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


MARKS = Marks()


def _draw(digest: Column, number: int) -> Column:
    """One of the digest's groups of eight hex digits, from 0, as a number."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("bigint")


def _literal(text: str) -> str:
    """A string as it stands, inside a pattern."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in text)


def _replacement(text: str) -> str:
    """A string as it stands, inside a replacement."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def transform(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 50,
    spm_percent: int = 80,
    seed: int = 42,
    marks: Marks = MARKS,
) -> DataFrame:
    """``docs`` with n (units), form, output, prefix_chars and middle_chars (code points, null for plain texts).

    ``percent`` of the texts are cut, ``spm_percent`` of these into suffix, prefix, middle (form spm), the others
    into prefix, suffix, middle (psm). The rest is plain, its output the text itself; so are empty texts
    and those that hold a mark. The id alone decides, so rows that repeat are treated alike; a null id
    draws as an empty one. A null text is empty. White space alone is one unit. Added columns replace those of
    their name, others pass through. An empty table stays empty.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    rows = docs.select(packed(docs), text.alias("text"), F.sha2(key.cast("binary"), 256).alias("digest"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("bigint"))
    cuts = [F.pmod(_draw(F.col("digest"), i), F.col("n") + 1) for i in (0, 1)]
    marked = F.contains("text", F.lit(marks.prefix)) | F.contains("text", F.lit(marks.suffix)) | F.contains("text", F.lit(marks.middle))
    plain = (F.col("text") == "") | (F.pmod(_draw(F.col("digest"), 2), F.lit(100)) >= percent) | marked
    form = F.when(plain, "plain").when(F.pmod(_draw(F.col("digest"), 3), F.lit(100)) < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumns({"first": F.least(*cuts), "last": F.greatest(*cuts), "form": form})
    units = [F.format_string(f"({UNIT}{{%d}}+)", c) for c in (F.col("first"), F.col("last") - F.col("first"))]
    pattern = F.concat(F.lit(r"(?s)\A"), *units, F.lit(r"(.*+)\z"))
    p, s, m = (_replacement(x) for x in (marks.prefix, marks.suffix, marks.middle))
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.withColumn("output", output)
    at = {k: F.instr(F.col("output"), v) for k, v in (("p", marks.prefix), ("s", marks.suffix), ("m", marks.middle))}
    prefix = F.when(F.col("form") == "spm", at["m"]).otherwise(at["s"]) - at["p"] - len(marks.prefix)
    cut = F.col("form") != "plain"
    return unpacked(
        rows,
        docs,
        n=F.col("n"),
        form=F.col("form"),
        output=F.col("output"),
        prefix_chars=F.when(cut, prefix).cast("bigint"),
        middle_chars=F.when(cut, F.length("output") - at["m"] + 1 - len(marks.middle)).cast("bigint"),
    )


def restore(output: Column, form: Column, marks: Marks = MARKS) -> Column:
    """The text that an output of that form was made of."""
    p, s, m = (_literal(x) for x in (marks.prefix, marks.suffix, marks.middle))
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_counted_infill(spark, sf_dir):
    """How every document is cut for filling in, with digests of what is written and what can be restored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = transform(docs).withColumn("restored", restore(F.col("output"), F.col("form")))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS h1,
         CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS h2,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:least(h1, h2)], ''), '') AS pre,
         coalesce(array_to_string(units[least(h1, h2) + 1:greatest(h1, h2)], ''), '') AS mid,
         coalesce(array_to_string(units[greatest(h1, h2) + 1:], ''), '') AS suf
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE body END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
