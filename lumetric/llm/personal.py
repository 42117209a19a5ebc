"""Personal data by patterns of form, and by contexts bootstrapped from what those find."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.session import settle

KINDS = ("email", "ip", "card", "phone")

# The contract's forms. Possessive repeats and the start conditions only keep the
# matcher from trying, in a long run of one kind of character, every later start
# or every shorter match: those could not succeed where the first attempt failed.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What else may stand in the place of such data: only where the context says so.
LOOSE = {
    "email": r"(?<![^\s<(\[\"':=,;])[A-Za-z0-9._%+-]{1,64}+\s?+(?:@|[\[(](?:at|AT)[\])])\s?+[A-Za-z0-9-]{1,64}+"
    r"(?:\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[A-Za-z0-9-]{1,64}+){0,8}+",
    "ip": r"(?<![0-9A-Za-z.:_-])[0-9A-Fa-f]{1,4}+(?:[.:_-][0-9A-Fa-f]{1,4}+){3,7}+(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z+.-])[0-9]{1,19}+(?:[\x20./-][0-9]{1,19}+){0,8}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?+[0-9]{1,15}+(?:[\x20)(./-]{1,3}+[0-9]{1,15}+){0,8}+(?![0-9A-Za-z])",
}
SPAN = "array<struct<kind: string, start: int, end: int>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has the check digit of card numbers."""
    turned = F.reverse(number)

    def worth(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    each = F.transform(F.sequence(F.lit(1), F.length(number)), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The contract's condition on a match."""
    n = F.length(digits(match))
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def plausible(kind: str, match: Column) -> Column:
    """Whether a loose match has about the size of its kind."""
    n = F.length(digits(match))
    if kind == "card":
        return (n >= 12) & (n <= 19)
    if kind == "phone":
        return (n >= 7) & (n <= 15)
    return F.lit(True)


MATCHES = "array<struct<text: string, start: int, end: int, before: string, after: string>>"


def with_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Add ``name``: all matches in ``text``, with their place (code points) and up to 80 characters before and after each.

    The pieces between matches, cut by the same pattern, give the places, so the
    text is searched twice at most, and the second time only where there is a match.
    """
    found, between, ends = f"_{name}_found", f"_{name}_between", f"_{name}_ends"
    df = df.withColumn(found, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn(between, F.when(F.size(found) > 0, F.split("text", pattern, -1)))
    df = df.withColumn(
        ends,
        F.when(
            F.size(found) > 0,
            F.aggregate(
                F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m)),
                F.array().cast("array<int>"),
                lambda a, x: F.array_append(a, F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) + x),
            ),
        ),
    )
    matches = F.transform(
        found,
        lambda m, i: F.struct(
            m.alias("text"),
            (F.get(ends, i) - F.length(m)).alias("start"),
            F.get(ends, i).alias("end"),
            F.right(F.get(between, i), F.lit(80)).alias("before"),
            F.left(F.get(between, i + 1), F.lit(80)).alias("after"),
        ),
    )
    none = F.array().cast(MATCHES)
    return df.withColumn(name, F.when(F.size(found) > 0, matches).otherwise(none)).drop(found, between, ends)


def of_kind(matches: str, kind: str, test: Callable[[str, Column], Column]) -> Column:
    """The matches that pass the kind's test, with their kind."""
    fields = ("start", "end", "text", "before", "after")
    return F.transform(
        F.filter(matches, lambda m: test(kind, m["text"])),
        lambda m: F.struct(F.lit(kind).alias("kind"), *[m[c].alias(c) for c in fields]),
    )


def spans_of(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def contexts(before: Column, after: Column) -> Column:
    """The one and the two words before a place and the one after it, lower case; words end at white space.

    The word after is marked by two blanks, which no words before have between them.
    """
    words, next_ = words_of(before), F.get(words_of(after), F.lit(0))
    one, two = (F.array_join(F.slice(words, -n, n), " ") for n in (1, 2))
    return F.concat(
        F.when(F.size(words) > 0, F.array(one)).otherwise(F.array().cast("array<string>")),
        F.when(F.size(words) > 1, F.array(two)).otherwise(F.array().cast("array<string>")),
        F.when(next_.isNotNull(), F.array(F.concat(F.lit("then  "), next_))).otherwise(F.array().cast("array<string>")),
    )


def written(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined, in order of kind as listed, then start."""
    def earlier(a: Column, b: Column) -> Column:
        return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)

    ordered = [F.array_sort(spans_of(spans, kind), earlier) for kind in KINDS]
    return F.array_join(
        F.transform(F.concat(*ordered), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = 3,
    confident: float = 0.6,
    support: int = 3,
) -> DataFrame:
    """doc_id, base and found (arrays of kind, start, end) of every row.

    ``base`` are the spans of the contract's forms. They seed the method: the one
    and two words before a seed, and the word after it, are lexical patterns of
    its kind. Pattern and instance (the text found) form a graph. A pattern's
    confidence is the summed score of its instances' occurrences over all it
    could extract: what looks like its kind there, and seeds of other kinds
    there. An instance's score is that of its best pattern, seeds scoring 1; both
    are computed in turn, ``rounds`` times. A pattern needs ``support`` different
    seeds. What looks like the kind without having its form is added as
    ``found`` where its own pattern, or its instance elsewhere, reaches
    ``confident``, unless it overlaps a base span or an earlier found one.

    Null texts are empty; texts without data have empty arrays; repeated rows
    get the same spans each and count each; other columns are ignored; no rows
    give no rows. Everything is DataFrame functions. Texts are searched
    row by row without a shuffle; only matches and counts of their contexts are
    shuffled, after partial sums, so a frequent context or instance is no burden
    to one task.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    marked = rows
    for kind in KINDS:
        marked = with_matches(marked, f"b_{kind}", BASE[kind])
        marked = with_matches(marked, f"l_{kind}", LOOSE[kind])
    seeds = F.concat(*[of_kind(f"b_{kind}", kind, passes) for kind in KINDS])
    loose = F.concat(*[of_kind(f"l_{kind}", kind, plausible) for kind in KINDS])

    def example(s: Column) -> Column:
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.lower(s["text"]).alias("instance"), contexts(s["before"], s["after"]).alias("words"))

    free = F.filter(
        "loose", lambda c: ~F.exists("seeds", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    )
    table = settle(
        marked.select("doc_id", seeds.alias("seeds"), loose.alias("loose"))
        .select("doc_id", F.transform("seeds", example).alias("seeds"), F.transform(free, example).alias("open"))
        .withColumn("row", F.monotonically_increasing_id()),
        "identifiers",
    )

    def edges(column: str, seed: int) -> DataFrame:
        each = table.select(F.explode(column).alias("s"))
        return each.select("s.kind", "s.instance", F.explode("s.words").alias("words"), F.lit(seed).alias("seed"))

    graph = settle(
        edges("seeds", 1).union(edges("open", 0)).groupBy("kind", "words", "instance").agg(
            F.count("*").alias("n"), F.max("seed").alias("seed")
        ),
        "graph",
    )
    seeded = F.when(F.col("seed") == 1, F.col("n")).otherwise(0)
    contexts_ = graph.groupBy("kind", "words").agg(
        F.sum("n").alias("own"), F.sum(seeded).alias("seeded"), F.count_if(F.col("seed") == 1).alias("seeds")
    )
    of_all = contexts_.groupBy("words").agg(F.sum("seeded").alias("of_all"))
    patterns = settle(
        contexts_.where(F.col("seeds") >= support)
        .join(of_all, "words")
        .select("kind", "words", (F.col("own") + F.col("of_all") - F.col("seeded")).alias("extracts")),
        "patterns",
    )
    edge = graph.join(patterns.select("kind", "words"), ["kind", "words"])
    scored = edge.withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds):
        sums = scored.groupBy("kind", "words").agg(F.sum(F.col("n") * F.col("score")).alias("good"))
        confidence = settle(
            sums.join(patterns, ["kind", "words"]).select(
                "kind", "words", (F.col("good") / F.col("extracts")).alias("confidence")
            ),
            "confidence",
        )
        instances = edge.join(confidence, ["kind", "words"]).groupBy("kind", "instance").agg(
            F.greatest(F.max("confidence"), F.max("seed")).alias("score")
        )
        scored = edge.join(instances, ["kind", "instance"])
    sure = confidence.where(F.col("confidence") >= confident)
    known = settle(
        edge.join(sure, ["kind", "words"]).select("kind", "instance").distinct(), "instances"
    )
    opened = table.select("row", F.explode("open").alias("s")).select("row", "s.*")
    by_words = opened.withColumn("w", F.explode("words")).join(
        sure.select("kind", F.col("words").alias("w")), ["kind", "w"], "left_semi"
    )
    by_instance = opened.join(known, ["kind", "instance"], "left_semi")
    added = (
        by_words.select("row", "kind", "start", "end").union(by_instance.select("row", "kind", "start", "end"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("added"))
    )
    # Of overlapping ones the first stays.
    apart = F.aggregate(
        F.coalesce("added", F.array().cast("array<struct<start: int, end: int, kind: string>>")),
        F.array().cast(SPAN),
        lambda kept, s: F.when(F.exists(kept, lambda o: s["start"] < o["end"]), kept).otherwise(
            F.array_append(kept, F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        ),
    )
    base = F.transform("seeds", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return table.join(added, "row", "left").select("doc_id", base.alias("base"), apart.alias("found"))


def report(found: DataFrame) -> DataFrame:
    """The spans of ``find`` as counts of the base ones by kind, their digest, and all spans as text."""
    counts = [
        F.size(spans_of("base", kind)).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "found")).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )
