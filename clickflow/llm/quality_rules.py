"""Quality rules with adaptive thresholds, DataFrame and SQL functions only.

Each text is measured. For every (lang, source) a mergeable quantile sketch of each measure gives
quartiles, and a text is an outlier where a measure lies beyond its group's fence,

    q75 + REACH * max(q75 - q25, least spread of the measure)

so the cutoff follows the group's own texts, and a group of like texts loses none. The sketches are
those of ``percentile_approx``: built per task, merged per group. Thresholds are joined to the
measured rows on (lang, source); null is a group of its own.

Texts are never shuffled, and only measures and fences are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import written

REACH = 3.0
ACCURACY = 10_000
#: Measure -> least spread: how far a text may be above its group before it is an outlier, times REACH.
SPREAD = {"symbol_share": 0.02, "repeat_share": 0.1, "dup_line_share": 0.12, "capital_share": 0.1, "adjacent_share": 0.05}
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
Q = "__q"


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``__q`` of the counts and shares of each text.

    Words are runs without white space (space and U+0009-U+000D). word_chars: code points in words;
    n_symbols: characters of ``#*$%&|<>``; n_dup_lines: lines with a word that equal an earlier line;
    n_repeat_words: words in any 8-word window found twice or more in the text, the first included.
    Shares, 0 where there is nothing to divide by: symbols and capitals A-Z of word_chars, words in
    repeated windows and words equal to the word before of n_words, repeated lines of lines with a
    word. A null text has no words. Other columns pass through, but for names that begin with ``__``,
    which are kept for the operator's own."""
    own = [F.col(f"`{c}`") for c in docs.columns if not c.startswith("__")]
    w, window = REPEAT_WINDOW, ", ".join(f"__h[i + {k}]" for k in range(REPEAT_WINDOW))
    split = docs.select(*own, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t")).withColumns({
        "__w": F.expr(r"filter(split(__t, '[\\x09-\\x0D\\x20]+'), w -> w != '')"),
        "__l": F.expr(r"filter(split(__t, '\n'), l -> l rlike '[^\\x09-\\x0D\\x20]')")})
    counted = split.select(*own, F.struct(
        F.size("__w").cast("bigint").alias("n_words"),
        F.expr("CAST(length(array_join(__w, '')) AS BIGINT)").alias("word_chars"),
        F.expr(r"CAST(length(__t) - length(regexp_replace(__t, '[#*$%&|<>]+', '')) AS BIGINT)").alias("n_symbols"),
        F.expr(r"CAST(length(__t) - length(regexp_replace(__t, '[A-Z]+', '')) AS BIGINT)").alias("n_capitals"),
        F.size("__l").cast("bigint").alias("n_lines"),
        F.expr("CAST(size(__l) - size(array_distinct(__l)) AS BIGINT)").alias("n_dup_lines"),
    ).alias("__c"), F.expr("transform(__w, w -> xxhash64(w))").alias("__h"))
    windows = counted.withColumns({
        "__v": F.expr(f"IF(size(__h) < {w}, CAST(array() AS array<bigint>), "
                      f"transform(sequence(0, size(__h) - {w}), i -> xxhash64({window})))"),
        "__a": F.expr("CAST(size(filter(__h, (x, i) -> i > 0 AND x = __h[greatest(i - 1, 0)])) AS BIGINT)")})
    # Only where some window comes twice are the windows sorted for the places of those that do.
    placed = windows.withColumn("__s", F.expr("""IF(size(array_distinct(__v)) = size(__v),
        CAST(array() AS array<struct<v:bigint,i:int>>), sort_array(transform(__v, (v, i) -> struct(v, i))))"""))
    starts = placed.withColumn("__p", F.expr("""sort_array(transform(filter(__s, (x, k) ->
        (k > 0 AND x.v = __s[greatest(k - 1, 0)].v) OR
        (k + 1 < size(__s) AND x.v = __s[least(k + 1, size(__s) - 1)].v)), x -> x.i))"""))
    repeated = starts.withColumn("__r", F.expr(f"""aggregate(__p, struct(0L AS n, -{w} AS last),
        (a, i) -> struct(a.n + least({w}, i - a.last) AS n, i AS last), a -> a.n)"""))
    c, n_repeat = F.col("__c"), F.col("__r")
    # A generator of one row: filters on the measures stay above it, so each is computed once.
    return repeated.select(*own, F.explode(F.array(F.struct(
        c.n_words.alias("n_words"), c.word_chars.alias("word_chars"), c.n_symbols.alias("n_symbols"),
        c.n_dup_lines.alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
        _share(c.n_symbols, c.word_chars).alias("symbol_share"), _share(n_repeat, c.n_words).alias("repeat_share"),
        _share(c.n_dup_lines, c.n_lines).alias("dup_line_share"), _share(c.n_capitals, c.word_chars).alias("capital_share"),
        _share(F.col("__a"), c.n_words).alias("adjacent_share"),
    ))).alias(Q))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def fences(measures: DataFrame) -> DataFrame:
    """(__lang, __source, __fence: measure -> the largest value that is no outlier) per group."""
    sketches = measures.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(*[
        F.percentile_approx(F.col(f"{Q}.{m}"), [0.25, 0.75], ACCURACY).alias(m) for m in SPREAD])
    return sketches.select("__lang", "__source", F.struct(*[
        (F.col(m)[1] + REACH * F.greatest(F.col(m)[1] - F.col(m)[0], F.lit(least))).alias(m)
        for m, least in SPREAD.items()]).alias("__fence"))


def judged(measures: DataFrame, fence: DataFrame) -> DataFrame:
    """``measures`` with struct ``__verdict``: base_failed (fewer than 20 words, or over 30 % of the
    words in repeated windows), outlier (a measure beyond its group's fence), kept (neither)."""
    joined = measures.join(fence, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")))
    base = (F.col(f"{Q}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{Q}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{Q}.n_words"))
    outlier = F.lit(False)
    for m in SPREAD:
        outlier = outlier | (F.col(f"{Q}.{m}") > F.col(f"__fence.{m}"))
    return joined.select(*[F.col(f"`{c}`") for c in measures.columns], F.struct(
        base.alias("base_failed"), outlier.alias("outlier"), (~base & ~outlier).alias("kept")).alias("__verdict"))


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, lang, source and any other columns) that are kept, unchanged. Rows
    are judged one by one, so repeated rows share their verdict; an empty table stays empty. Texts
    are measured twice, for the fences and for the verdicts: that costs less than moving or storing
    them with their measures."""
    rows = judged(measured(docs), written(fences(measured(docs)), "fences"))
    return rows.where("__verdict.kept").drop(Q, "__verdict")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, outlier."""
    measures = written(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measured")
    rows = judged(measures, written(fences(measures), "fences"))
    return rows.select("doc_id", *[F.col(f"{Q}.{c}") for c in COUNTS], "__verdict.base_failed", "__verdict.kept",
                       "__verdict.outlier")
