"""Quality rules with thresholds learnt from the corpus itself.

Instead of one fixed cutoff, each (language, source) has its own fences, read
from mergeable quantile sketches. The sketches of small sources are merged into
those of their language, and of small languages into that of all documents.
Everything here is a built-in function; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.common import SPACED, let, quoted, stored, words_of

# The base rule.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# The rates held against fences, with the greatest slack of a fence. The slack is
# a high quantile of the rate, but no more than this, as junk may reach that
# quantile, and no less than a tenth: a spread of zero must not turn a single odd
# character into a reject.
RATES = {
    "symbol_rate": 0.05,
    "upper_rate": 0.10,
    "dup_line_rate": 0.50,
    "repeat_rate": 0.25,
    "echo_rate": 0.10,
}
LENGTH_SLACK = 1.0
SLACK_QUANTILE = 0.99
LEAST_SLACK = 0.1
REACH = 3.0
SKETCH_K = 1024
MIN_STRATUM = 100


def _windows(hashes: Column, window: int) -> Column:
    """One hash per window of neighbouring words."""
    places = F.sequence(F.lit(0), F.size(hashes) - window)
    one = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])
    none = F.array().cast("array<bigint>")
    return F.when(F.size(hashes) >= window, F.transform(places, one)).otherwise(none)


def _covered(pairs: Column, window: int) -> Column:
    """Words covered by windows that occur twice or more.

    ``pairs`` holds (hash, place) in order, so a window's copies are neighbours
    and a text costs n log n at any length.
    """

    def twice(x: Column, i: Column) -> Column:
        return (x["h"] == F.get(pairs, i - 1)["h"]) | (x["h"] == F.get(pairs, i + 1)["h"])

    starts = F.sort_array(F.transform(F.filter(pairs, twice), lambda x: x["place"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("total"), F.lit(-window).alias("last")),
        lambda acc, p: F.struct(
            (acc["total"] + F.least(F.lit(window), p - acc["last"])).alias("total"),
            p.alias("last"),
        ),
        lambda acc: acc["total"],
    )


def _repeated_words(hashes: Column, window: int) -> Column:
    def of_windows(windows: Column) -> Column:
        pairs = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("place")))
        )
        none = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(none, F.lit(0)).otherwise(let(pairs, lambda p: _covered(p, window)))

    return let(_windows(hashes, window), of_windows)


def _counts(words: Column, window: int) -> Column:
    """A struct of the counts that need the words."""

    def of_hashes(hashes: Column) -> Column:
        letters = F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.char_length(w))
        echoes = F.filter(hashes, lambda h, i: h == F.get(hashes, i - 1))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            letters.alias("word_chars"),
            _repeated_words(hashes, window).cast("long").alias("n_repeat_words"),
            F.size(echoes).alias("n_echoes"),
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _line_counts(lines: Column) -> Column:
    def of(worded: Column) -> Column:
        extra = F.size(worded) - F.size(F.array_distinct(worded))
        return F.struct(F.size(worded).alias("n_lines"), extra.cast("long").alias("n_dup_lines"))

    return let(F.filter(lines, lambda x: x.rlike(SPACED)), of)


def text_metrics(rows: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Adds the counts of the base rule and the rates to rows with a ``body``."""
    names = rows.columns
    body = F.coalesce(F.col("body"), F.lit(""))
    counted = rows.select(
        *names,
        let(words_of(F.col("body")), lambda words: _counts(words, window)).alias("of_words"),
        _line_counts(F.split(body, "\n", -1)).alias("of_lines"),
        F.char_length(F.regexp_replace(body, rf"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace(body, r"\P{Lu}+", "")).alias("n_upper"),
    ).select(*names, "of_words.*", "of_lines.*", "n_symbols", "n_upper")
    share = lambda n, of: F.col(n) / F.greatest(F.col(of), F.lit(1))
    return counted.select(
        *names,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_rate"),
        share("n_upper", "word_chars").alias("upper_rate"),
        share("n_dup_lines", "n_lines").alias("dup_line_rate"),
        share("n_repeat_words", "n_words").alias("repeat_rate"),
        share("n_echoes", "n_words").alias("echo_rate"),
        share("word_chars", "n_words").alias("mean_word"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def _measures() -> list[str]:
    return [*RATES, "mean_word"]


def stratum_sketches(metrics: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Rows (lang, source, n, one quantile sketch per measure) of documents past the base rule.

    A sketch has at most a few times ``k`` values, whatever the stratum's size.
    """
    measured = metrics.filter(~base_failed())
    return measured.groupBy("lang", "source").agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(F.col(m), F.lit(k)).alias(m) for m in _measures()],
    )


def fences(sketches: DataFrame, reach: float = REACH, min_rows: int = MIN_STRATUM) -> DataFrame:
    """Rows (lang, source, bounds): a struct with ``m_lo`` and ``m_hi`` per measure.

    A stratum of fewer than ``min_rows`` documents takes the merged sketches of
    its language, and a language of fewer those of the whole corpus. The fence of
    a rate is never above that of its language or of the corpus, so that a source
    of which much is junk does not set its own; nor is that of the mean word
    length outside its language's, while languages differ in it.
    """
    merged = [F.kll_merge_agg_double(F.col(m)).alias(m) for m in _measures()]

    def bounds(prefix: str) -> Column:
        parts = []
        for m in _measures():
            q1, q3 = [
                F.kll_sketch_get_quantile_double(F.col(prefix + m), F.lit(p)) for p in (0.25, 0.75)
            ]
            if m in RATES:
                high = F.kll_sketch_get_quantile_double(F.col(prefix + m), F.lit(SLACK_QUANTILE))
                slack = F.greatest(F.least(high, F.lit(RATES[m])), F.lit(LEAST_SLACK * RATES[m]))
            else:
                slack = F.lit(LENGTH_SLACK)
            parts += [
                (q1 - reach * (q3 - q1) - slack).alias(f"{m}_lo"),
                (q3 + reach * (q3 - q1) + slack).alias(f"{m}_hi"),
            ]
        return F.struct(*parts)

    by_lang = (
        sketches.groupBy("lang")
        .agg(F.sum("n").alias("n"), *merged)
        .select(F.col("lang").alias("of_lang"), F.col("n").alias("lang_n"), bounds("").alias("lang_b"))
    )
    overall = sketches.agg(F.count("*").alias("n"), *merged).filter("n > 0").select(bounds(""))
    own = sketches.select("lang", "source", "n", bounds("").alias("own_b"))
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left").select(
        "lang",
        "source",
        F.when(F.col("n") >= min_rows, F.col("own_b")).alias("own_b"),
        F.when(F.col("lang_n") >= min_rows, F.col("lang_b")).alias("lang_b"),
        overall.scalar().alias("all_b"),
    )

    def bound(name: str) -> Column:
        levels = [F.col(level)[name] for level in ("own_b", "lang_b", "all_b")]
        if name.startswith("mean_word"):
            tightest = F.greatest if name.endswith("_lo") else F.least
            return F.coalesce(tightest(*levels[:2]), levels[2]).alias(name)
        return (F.coalesce(*levels) if name.endswith("_lo") else F.least(*levels)).alias(name)

    names = [f"{m}_{end}" for m in _measures() for end in ("lo", "hi")]
    return joined.select("lang", "source", F.struct(*[bound(n) for n in names]).alias("bounds"))


def judge(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with metrics, by their stratum's fences.

    The metrics come first in the join: a merge join streams that side, and
    adaptive execution splits a stratum that holds a third of all rows.
    """
    named = bounds.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = metrics.join(
        named,
        F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")),
        "left",
    )
    within = F.lit(True)
    for m in RATES:
        within = within & (F.col(m) <= F.col("bounds")[f"{m}_hi"])
    low, high = F.col("bounds")["mean_word_lo"], F.col("bounds")["mean_word_hi"]
    within = within & F.col("mean_word").between(low, high)
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    ).drop("of_lang", "of_source", "bounds")


def _keyed(docs: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    id_col, text_col, lang_col, source_col = names
    return docs.select(
        quoted(id_col).alias("id"),
        quoted(text_col).alias("body"),
        quoted(lang_col).cast("string").alias("lang"),
        quoted(source_col).cast("string").alias("source"),
        F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
    )


def quality_verdicts(
    docs: DataFrame,
    reach: float = REACH,
    min_rows: int = MIN_STRATUM,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: id, lang, source, counts, rates, ``base_failed``, ``kept``.

    A document is kept if it passes the base rule and all its rates and its
    mean word length lie within the fences of its language and source: the
    quartiles, widened by ``reach`` times their distance and a small slack, and
    bounded by the fences of the language and of the corpus (see ``fences``).

    A null or empty text has no words and fails the base rule. Null languages
    and sources are strata of their own. Repeated rows each count and each get
    a verdict. Other columns are not looked at; an empty table gives an empty
    table.
    """
    keyed = _keyed(docs, (id_col, text_col, lang_col, source_col)).drop("row")
    # The texts are read once; the metrics, needed twice, are a few numbers per row.
    metrics = stored(text_metrics(keyed).drop("body"), "text-metrics")
    bounds = stored(fences(stratum_sketches(metrics), reach, min_rows), "fences")
    return judge(metrics, bounds).withColumnRenamed("id", id_col)


def filter_documents(
    docs: DataFrame,
    reach: float = REACH,
    min_rows: int = MIN_STRATUM,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps, with all their columns."""
    keyed = _keyed(docs, (id_col, text_col, lang_col, source_col))
    sketches = stratum_sketches(text_metrics(keyed.drop("row")))
    bounds = stored(fences(sketches, reach, min_rows), "fences")
    return judge(text_metrics(keyed), bounds).filter("kept").select("row.*")
