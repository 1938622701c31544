"""Quality rules: counting rules, and divergence of character classes and common words from the language.

Every document gets counts over its whole text. It fails a *base* rule if it has fewer than ``min_words`` words or if more
than ``max_repeat_pct`` per cent of them lie in five-word windows that its text holds twice or more. The others are
compared with references of their language, taken over all documents of that language: Jensen-Shannon distance (base 2,
0 to 1) between histograms of character classes, and of the language's common words. Distances of short documents are
noise, so each comparison has a minimum length.

Everything is a Spark expression on the row; two passes over the texts and no shuffle of texts. The references are one row
per listed language and one for all other languages, so the broadcast of them is bounded by the list.

Defined results: null or blank texts have no words and fail the base rule; null or unlisted languages share one reference
without common words; repeated rows give repeated results; extra columns do not matter, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickweave.llm.common import SPACE, fresh, text_of, words_of

# Common function words by language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "are", "from"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "sur", "au", "pas"],
}
# Counted classes; letters and everything else that none of them and no word separator is make up the last bin.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "symbol": "[#*$%&|<>]", "punct": r"[.,;:!?'\"()\[\]{}/_=+@~^`\\-]", "wide": r"[^\x00-\x7F]"}

MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
MIN_CLASS_CHARS, MAX_CLASS_DISTANCE = 200, 0.34
MIN_COMMON_WORDS, MAX_WORD_DISTANCE = 50, 0.45


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two columns of shares; null where either is null."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest(F.lit(0.0), _sum(F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2))))


def _listed(lang: Column, languages: list[str]) -> Column:
    return F.when(lang.isin(languages), lang).otherwise(F.lit(""))


def _class_counts(text: Column, words: Column) -> Column:
    """Counts by character class, word separators and all other characters; a character counts once."""
    classes = [F.regexp_count(text, F.lit(p)) for p in CLASSES.values()]
    spaces = F.length(text) - F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w))
    return F.transform(F.array(*classes, spaces, F.length(text)), lambda x: x.cast("double"))


def _pinned(value: Column) -> Column:
    """The same value, but filters stay above it: moved below, they would take the expressions into every lambda again."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _with_counts(df: DataFrame, text: Column, lang: str, common: dict[str, list[str]], c: dict[str, str]) -> DataFrame:
    """Adds the words and both histograms. Each step is a projection of its own: what a lambda reads must be a column."""
    df = df.withColumns({c["lang"]: _listed(F.coalesce(F.col(lang).cast("string"), F.lit("")), [*common]), c["words"]: words_of(text)})
    wanted = F.coalesce(*[F.when(F.col(c["lang"]) == k, F.array(*map(F.lit, v))) for k, v in common.items()], F.array().cast("array<string>"))
    df = df.withColumns({c["classes"]: _class_counts(text, F.col(c["words"])), c["wanted"]: wanted})
    df = df.withColumn(c["hits"], F.filter(c["words"], lambda w: F.array_contains(c["wanted"], w)))
    counted = F.transform(c["wanted"], lambda x: F.size(F.filter(c["hits"], lambda w: w == x)))
    last = len(CLASSES) + 1
    rest = F.element_at(c["classes"], last + 1) - _sum(F.slice(c["classes"], 1, last))
    return df.withColumns({
        c["classes"]: F.concat(F.slice(c["classes"], 1, last), F.array(rest)),
        c["common"]: F.transform(F.concat(counted, F.array(F.size(c["words"]) - F.size(c["hits"]))), lambda x: x.cast("double")),
    })


def _with_repeats(df: DataFrame, c: dict[str, str], size: int = WINDOW) -> DataFrame:
    """Adds how many words lie in windows of ``size`` words that the text holds twice or more."""
    w, n = F.col(c["words"]), F.size(c["words"])
    hashes = F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])))
    df = df.withColumn(c["hashes"], hashes)
    df = df.withColumn(c["twice"], F.size(F.array_distinct(c["hashes"])) < F.size(c["hashes"]))
    # only texts with a repeated window are looked at more closely
    df = df.withColumn(c["pairs"], F.when(F.col(c["twice"]), F.sort_array(F.transform(c["hashes"], lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda p, j: F.coalesce(F.get(c["pairs"], j)["h"] == p["h"], F.lit(False))
    df = df.withColumn(c["starts"], F.sort_array(F.transform(F.filter(c["pairs"], lambda p, i: same(p, i - 1) | same(p, i + 1)), lambda p: p["i"])))
    widths = F.transform(c["starts"], lambda p, i: F.least(F.lit(size), F.coalesce(F.get(c["starts"], i + 1) - p, F.lit(size))))
    return df.withColumn(c["repeats"], _pinned(F.coalesce(F.aggregate(widths, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")))


def _names(df: DataFrame) -> dict[str, str]:
    parts = ("lang", "words", "classes", "wanted", "hits", "common", "hashes", "twice", "pairs", "starts", "repeats", "text",
             "ref_lang", "ref_class", "ref_common", "share_class", "share_common", "d_class", "d_common", "n", "failed", "kept")
    return {k: fresh(df, f"quality_{k}") for k in parts}


def language_references(df: DataFrame, text: str = "text", lang: str = "lang", common: dict[str, list[str]] | None = None) -> DataFrame:
    """Shares ``ref_lang, ref_class, ref_common`` over all documents: a row per listed language and one (``''``) for the rest."""
    common = COMMON_WORDS if common is None else common
    rows = df.select(text_of(text).alias("t"), F.col(lang).cast("string").alias("l"))
    c = _names(rows)
    rows = _with_counts(rows, F.col("t"), "l", common, c).select(F.col(c["lang"]).alias("lang"), F.col(c["classes"]).alias("c"), F.col(c["common"]).alias("d"))
    classes, width = len(CLASSES) + 2, max(map(len, common.values()), default=0) + 1
    sums = rows.groupBy("lang").agg(
        *[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(classes)], *[F.sum(F.get("d", F.lit(i))).alias(f"d{i}") for i in range(width)],
    )
    sums = sums.select("lang", F.array(*[f"c{i}" for i in range(classes)]).alias("c"), F.filter(F.array(*[f"d{i}" for i in range(width)]), lambda x: x.isNotNull()).alias("d"))
    sums = sums.select("lang", "c", "d", _sum(F.col("c")).alias("cs"), _sum(F.col("d")).alias("ds"))
    return sums.select(F.col("lang").alias("ref_lang"), F.when(F.col("cs") > 0, _shares(F.col("c"), F.col("cs"))).alias("ref_class"), F.when(F.col("ds") > 0, _shares(F.col("d"), F.col("ds"))).alias("ref_common"))


def judged(
    df: DataFrame, text: str = "text", lang: str = "lang", common: dict[str, list[str]] | None = None, references: DataFrame | None = None,
    min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
    min_class_chars: int = MIN_CLASS_CHARS, max_class_distance: float = MAX_CLASS_DISTANCE,
    min_common_words: int = MIN_COMMON_WORDS, max_word_distance: float = MAX_WORD_DISTANCE,
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with further columns of counts, distances and verdict, and the names they got (none that ``df`` has)."""
    common = COMMON_WORDS if common is None else common
    references = language_references(df, text, lang, common) if references is None else references
    c = _names(df)
    t = text_of(text)
    out = _with_repeats(_with_counts(df, t, lang, common, c), c)
    refs = references.toDF(c["ref_lang"], c["ref_class"], c["ref_common"])
    out = out.join(F.broadcast(refs), F.col(c["lang"]) == F.col(c["ref_lang"]), "left")  # at most len(common) + 1 rows
    n = F.size(c["words"])
    out = out.withColumns({
        c["share_class"]: F.when(F.length(t) >= max(1, min_class_chars), _shares(F.col(c["classes"]), F.length(t))),
        c["share_common"]: F.when(n >= max(1, min_common_words), _shares(F.col(c["common"]), n)),
    })
    out = out.withColumns({c["d_class"]: _pinned(_distance(F.col(c["share_class"]), F.col(c["ref_class"]))), c["d_common"]: _pinned(_distance(F.col(c["share_common"]), F.col(c["ref_common"])))})
    out = out.withColumn(c["failed"], (n < min_words) | (100 * F.col(c["repeats"]) > max_repeat_pct * n))
    odd = F.coalesce(F.col(c["d_class"]) > max_class_distance, F.lit(False)) | F.coalesce(F.col(c["d_common"]) > max_word_distance, F.lit(False))
    return out.withColumn(c["kept"], ~F.col(c["failed"]) & ~odd), c


def quality_rules(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: its id, the counts, both distances, ``base_failed`` and ``kept``."""
    out, c = judged(df, text, **how)
    t = text_of(text)
    lines = _lines(t)
    return out.select(
        F.col(doc_id).alias("doc_id"), F.size(c["words"]).cast("long").alias("n_words"),
        F.aggregate(c["words"], F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(CLASSES["symbol"])).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.col(c["repeats"]).alias("n_repeat_words"), F.col(c["d_class"]).alias("class_distance"), F.col(c["d_common"]).alias("word_distance"),
        F.col(c["failed"]).alias("base_failed"), F.col(c["kept"]).alias("kept"),
    )


def keep_good(df: DataFrame, **how) -> DataFrame:
    """The rows of ``df``, all columns unchanged, whose document is kept."""
    out, c = judged(df, **how)
    return out.filter(c["kept"]).select(*[F.col(f"`{x}`") for x in df.columns])
