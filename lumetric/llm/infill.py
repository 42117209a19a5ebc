"""Fill-in-middle transformation by counted-quantifier patterns, all in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.llm.common import WORD

BLANK = r"[\x20\x09-\x0D]"
UNIT = rf"{BLANK}*{WORD}|{BLANK}+"
# Sentinels of the output, and a pattern for any of them.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = f"{PREFIX}|{SUFFIX}|{MIDDLE}"


def hash_of(digest: Column, i: int) -> Column:
    """The ``i``-th group of eight hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def cutting_pattern(first: Column, second: Column) -> Column:
    """A pattern whose groups are the first units, those up to the second count, and the rest.

    The counts are in the pattern itself. Possessive quantifiers never give a
    unit back, so the match walks once over the text, in constant stack space.
    """
    unit = f"(?:{UNIT})"
    return F.concat(
        F.lit(rf"\A({unit}{{"), first.cast("string"),
        F.lit(rf"}}+)({unit}{{"), (second - first).cast("string"),
        F.lit(r"}+)([\s\S]*)\z"),
    )


def transform(
    docs: DataFrame,
    *,
    seed: int = 42,
    percent: int = 50,
    suffix_first_percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, text, n, form, output, prefix_chars, middle_chars, restored of every row.

    A text is cut into ``n`` units, a word with the blanks before it or the
    blanks at the end. Two cuts, drawn from a hash of seed and id, part it into
    prefix, middle and suffix, each possibly empty. ``percent`` of the texts are
    rearranged: ``suffix_first_percent`` of these as suffix, prefix, middle
    (``spm``), the others as prefix, suffix, middle (``psm``); the rest stays
    ``plain``. So do texts that are empty or hold a sentinel, which could not be
    told apart again. ``restored`` is the text put together again from ``output``
    and ``form`` alone.

    A null text is an empty one. A null id is hashed as an empty string. Rows of
    equal id are cut by the same hashes, so repeated rows share everything. Other
    columns are ignored; no rows give no rows. No row meets another: there is no
    shuffle, and memory is that of one text.
    """
    key = F.col(f"`{id_column}`")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(key.alias("doc_id"), text.alias("text"), digest.alias("digest")).withColumn(
        "n", F.regexp_count("text", F.lit(UNIT)).cast("long")
    )
    cut = [F.pmod(hash_of(F.col("digest"), i), F.col("n") + 1) for i in (0, 1)]
    kept = (F.col("n") == 0) | F.col("text").rlike(SENTINEL) | (hash_of(F.col("digest"), 2) % 100 >= percent)
    form = F.when(kept, "plain").otherwise(
        F.when(hash_of(F.col("digest"), 3) % 100 < suffix_first_percent, "spm").otherwise("psm")
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"
    )
    moved = F.regexp_replace("text", cutting_pattern(F.least(*cut), F.greatest(*cut)), order)
    made = rows.withColumn("form", form).withColumn(
        "output", F.when(F.col("form") == "plain", F.col("text")).otherwise(moved)
    )
    return restored(made)


def restored(rows: DataFrame) -> DataFrame:
    """Rows of ``form`` and ``output`` with the parts' sizes and the text they restore."""
    parts = F.when(F.col("form") != "plain", F.split("output", SENTINEL))
    spm = F.col("form") == "spm"
    prefix = F.when(spm, F.get("_parts", F.lit(2))).otherwise(F.get("_parts", F.lit(1)))
    suffix = F.when(spm, F.get("_parts", F.lit(1))).otherwise(F.get("_parts", F.lit(2)))
    middle = F.get("_parts", F.lit(3))
    return rows.withColumn("_parts", parts).select(
        "doc_id", "text", "n", "form", "output",
        F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(middle).cast("long").alias("middle_chars"),
        F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat(prefix, middle, suffix)).alias("restored"),
    )


def report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``transform``'s rows."""
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE = rf"""
with texts as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as d,
    regexp_extract_all(coalesce(text, ''), '{UNIT}') as units
  from documents
), hashes as (
  select *, cast(len(units) as bigint) as n,
    cast('0x' || substr(d, 1, 8) as bigint) as h1, cast('0x' || substr(d, 9, 8) as bigint) as h2,
    cast('0x' || substr(d, 17, 8) as bigint) as h3, cast('0x' || substr(d, 25, 8) as bigint) as h4
  from texts
), cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
      then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from hashes
), parts as (
  select doc_id, text, n, form, array_to_string(units[1:a], '') as prefix,
    array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix
  from cuts
)
select doc_id, n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
