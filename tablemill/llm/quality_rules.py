r"""Quality rules whose thresholds adapt to language and source, in native expressions only.

Every document gets a few counts. Documents that fail the fixed base are out. Of the others,
four shares per document enter quantile sketches, one per language, source and share. A sketch is
a table of buckets: small numbers have their own bucket, larger ones share it with those that agree
in their leading ``LEADING`` binary digits, so a quantile is at most one part in 32 too low. Sketches
merge by adding the counts of equal buckets: partial ones of the tasks into one of a group, those of
the sources into one of a language, those into one of all. Their size does not depend on the number
of documents, and adding is exact, so the thresholds do not depend on how rows are dealt.

A share is an outlier beyond ``REACH`` times the distance of the quartiles from the median of its
group. Groups of fewer than ``ENOUGH`` documents use the sketch of their language, languages of
fewer that of all. The thresholds, one row per group, are joined to the documents.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col, computed_once

BETWEEN = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
LEADING = 6
REACH = 6
ENOUGH = 100
# Shares in thousandths, and the least distance of the quartiles that counts for each: most
# texts repeat nothing, and the first that does is not therefore an outlier.
SHARES = {"word_length": 50, "symbols": 10, "repeated": 50, "equal_lines": 75}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(w: str) -> tuple[Column, Column, Column]:
    """Three steps from the words ``w`` to the words in repeated windows of three, each a
    column that the next one names: windows sorted by their words (``s``), the places
    of those equal to a neighbour (``p``), words under them."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("p")),
    )
    sorted_windows = F.sort_array(F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<struct<g:string,p:int>>")))

    def same(i: Column, x: Column) -> Column:
        return F.coalesce(F.get("s", i)["g"] == x["g"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("s", lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["p"]))
    under = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    return sorted_windows, places, under


def text_counts(df: DataFrame, text_column: str, keep: list[Column]) -> DataFrame:
    """The columns ``keep``, the counts of the whole text, and ``n_lines`` (lines with a word)."""
    names = [f"k{i}" for i in range(len(keep))]
    kept = [F.col(n) for n in names]
    t = F.coalesce(col(text_column), F.lit(""))
    rows = df.select(*[k.alias(n) for k, n in zip(keep, names)], t.alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: without(x, BLANKS) != "")
    rows = computed_once(rows, [
        *kept,
        F.filter(F.split("t", BETWEEN + "+", -1), lambda x: x != "").alias("w"),
        F.length(without(F.col("t"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("l"),
    ])
    sorted_windows, places, under = repeated_words("w")
    done = ["word_chars", "n_symbols"]
    rows = computed_once(rows, [
        *kept, *[F.col(c) for c in done],
        F.size("w").cast("long").alias("n_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        sorted_windows.alias("s"),
    ])
    done += ["n_words", "n_lines", "n_dup_lines"]
    rows = computed_once(rows, [*kept, *[F.col(c) for c in done], places.alias("p")])
    return rows.select(*kept, *done, under.alias("n_repeat_words"))


def shares() -> dict[str, Column]:
    """Shares in thousandths, whole numbers; for documents that pass the base."""
    per = lambda part, whole: F.expr(f"1000 * {part} div {whole}")
    return {
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "n_words"),
        "repeated": per("n_repeat_words", "n_words"),
        "equal_lines": per("n_dup_lines", "n_lines"),
    }


def bucket(v: Column) -> Column:
    """Smallest number of the bucket of a whole number from 0: its leading binary digits."""
    shift = F.greatest(F.length(F.bin(v)) - LEADING, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(rows: DataFrame, groups: list[str], values: dict[str, Column]) -> DataFrame:
    """One mergeable sketch per group and value: ``groups``, ``share``, ``b``, ``n``."""
    each = F.array(*[F.struct(F.lit(name).alias("share"), bucket(v).alias("b")) for name, v in values.items()])
    return rows.select(*groups, F.inline(each)).groupBy(*groups, "share", "b").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of a coarser grouping: the counts of equal buckets are added."""
    return sketch.groupBy(*groups, "share", "b").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """``q1``, ``q2``, ``q3`` (buckets) and ``total`` per sketch."""
    # A sketch has at most 32 * 58 + 64 rows, however many values it stands for.
    key = ", ".join([*groups, "share"])
    running = sketch.selectExpr(
        *groups, "share", "b",
        f"sum(n) over (partition by {key} order by b) as below",
        f"sum(n) over (partition by {key}) as total",
    )
    at = lambda k: F.min(F.when(F.col("below") * 4 >= F.col("total") * k, F.col("b"))).alias(f"q{k}")
    return running.groupBy(*groups, "share").agg(at(1), at(2), at(3), F.max("total").alias("total"))


def fences(quarters: DataFrame, groups: list[str]) -> DataFrame:
    """``total``, and per share ``low`` and ``high``: one row per group."""
    least = F.element_at(F.create_map(*[F.lit(x) for pair in SHARES.items() for x in pair]), F.col("share"))
    reach = REACH * F.greatest(F.col("q3") - F.col("q1"), least)
    ends = quarters.select(*groups, "share", "total", (F.col("q2") - reach).alias("low"), (F.col("q2") + reach).alias("high"))
    picked = [
        F.max(F.when(F.col("share") == name, F.col(end))).alias(f"{name}_{end}") for name in SHARES for end in ("low", "high")
    ]
    return ends.groupBy(*groups).agg(F.max("total").alias("total"), *picked)


def thresholds(sketch: DataFrame, enough: int) -> DataFrame:
    """Per language and source ``lang``, ``src``: the fences of the finest grouping with
    enough documents."""
    ends = [f"{name}_{end}" for name in SHARES for end in ("low", "high")]
    by_language = merged(sketch, ["lang"])
    everything = merged(by_language, [])
    fine = fences(quartiles(sketch, ["lang", "src"]), ["lang", "src"]).alias("f")
    middle = fences(quartiles(by_language, ["lang"]), ["lang"]).alias("m")
    # The fences of all documents are one row: constants of the plan.
    coarse = fences(quartiles(everything, []), []).first()
    joined = fine.join(own_exchange(middle).alias("m"), F.col("f.lang").eqNullSafe(F.col("m.lang")), "left")
    pick = lambda c: (
        F.when(F.col("f.total") >= enough, F.col(f"f.{c}"))
        .when(F.col("m.total") >= enough, F.col(f"m.{c}"))
        .otherwise(F.lit(coarse[c])).alias(c)
    )
    return joined.select("f.lang", "f.src", *[pick(c) for c in ends])


def judge_quality(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    source_column: str = "source",
    enough: int = ENOUGH,
) -> DataFrame:
    """Per row: id, the counts, ``base_failed``, ``kept``.

    A null text has no words, so it fails the base, as does an empty one. Null languages and
    sources are groups of their own. Rows that repeat an id, or are equal, are each judged and
    each counted in the sketches; null ids are ids. An empty table gives an empty result. Very long texts are
    read whole: the work in one row is that of sorting its windows. Other columns are not read.
    """
    rows = staged(
        text_counts(df, text_column, [col(id_column), col(language_column), col(source_column)])
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))),
        "counts",
    )
    values = shares()
    fit = rows.where("not base_failed").select(F.col("k1").alias("lang"), F.col("k2").alias("src"), "*")
    limits = thresholds(staged(sketches(fit, ["lang", "src"], values), "sketches"), enough)
    joined = rows.join(
        own_exchange(limits), F.col("k1").eqNullSafe(F.col("lang")) & F.col("k2").eqNullSafe(F.col("src")), "left"
    )
    inside = [v.between(F.col(f"{name}_low"), F.col(f"{name}_high")) for name, v in values.items()]
    return joined.select(
        F.col("k0").alias(id_column),
        *COUNTS,
        "base_failed",
        F.when(F.col("base_failed"), False).otherwise(F.coalesce(reduce(and_, inside), F.lit(True))).alias("kept"),
    )


def drop_poor(df: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df``, with their columns, whose id is kept; rows that share an id go
    together, where one of them fails."""
    failed = judge_quality(df, id_column=id_column, **options).where("not kept")
    failed = failed.select(col(id_column).alias("__failed")).distinct()
    return df.join(own_exchange(failed), col(id_column).eqNullSafe(F.col("__failed")), "left_anti")
