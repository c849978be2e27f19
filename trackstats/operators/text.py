"""Word counts, stems, language, sentiment and readability of long texts.

Counts of words explode a text and are reduced again by map-side combined
aggregation before anything is shuffled; scores of a text are made inside its row
(``scoring``). The text column itself never leaves its task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from ..functions.stem import porter
from .keys import once, stored, top_n
from .scoring import scored, tallies

DEFAULT_STOPWORDS = sorted({*vocab.LYRIC_STOPWORDS, *vocab.ENGLISH_EXTRA_STOPWORDS})


def merge_vocabularies(*tables: DataFrame) -> DataFrame:
    """Union of one-column word lists, each word once."""
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out.distinct()


def spaced_words(text) -> Column:
    """The cleaned text: lower case, only words and white space."""
    return S.punctuation_to_space(S.strip_markers(F.lower(text)))


def word_list(text) -> Column:
    """All words of the cleaned text."""
    return F.array_remove(F.split(spaced_words(text), r"\s+"), "")


def words(df: DataFrame, keep: list[str], text: str = "Lyrics") -> DataFrame:
    """``(keep..., word)``, one row per word of the cleaned text."""
    return df.select(*keep, F.explode(word_list(text)).alias("word"))


def word_counts(df: DataFrame, group: list[str], *, text: str = "Lyrics",
                stopwords: list[str] | DataFrame = DEFAULT_STOPWORDS, min_length: int = 3) -> DataFrame:
    """``(group..., word, n)`` of content words."""
    found = words(df, group, text).where(F.length("word") >= min_length)
    if isinstance(stopwords, list):
        found = found.where(~F.col("word").isin(stopwords))
    counts = found.groupBy(*group, "word").agg(F.count(F.lit(1)).alias("n"))
    if isinstance(stopwords, DataFrame):  # a table of any size, applied to the reduced counts
        listed = stopwords.toDF("word").distinct()
        counts = counts.join(listed, "word", "left_anti")
    return counts


def stem_counts(counts: DataFrame, group: list[str], *, lemmas: DataFrame | None = None,
                stem: Callable[[DataFrame, str, str], DataFrame] | None = porter) -> DataFrame:
    """``(group..., stem, Word, Frequency)``: counts per stem and its commonest surface form.

    Works on per-word counts; a word is stemmed once, however many groups it is in. A ``(word, lemma)`` table is applied before
    stemming. Ties between surface forms go to the alphabetically first.
    """
    base = F.col("word")
    if lemmas is not None:
        table = lemmas.groupBy("word").agg(F.min("lemma").alias("lemma"))
        counts = counts.join(table, "word", "left")
        base = F.coalesce("lemma", "word")
    counts = counts.withColumn("__base", base)
    if stem:
        stems = stem(counts.select("__base").distinct(), "__base", "stem")
        counts = counts.join(stems, "__base")
    else:
        counts = counts.withColumn("stem", F.col("__base"))
    per_surface = counts.groupBy(*group, "stem", "word").agg(F.sum("n").alias("n"))
    commonest = F.struct((-F.col("n")).alias("n"), F.col("word").alias("w"))
    return per_surface.groupBy(*group, "stem").agg(
        F.min_by("word", commonest).alias("Word"), F.sum("n").alias("Frequency"))


def top_words(df: DataFrame, n: int = 100, *, year: str = "Year", text: str = "Lyrics",
              language: str | None = "en", **options) -> DataFrame:
    """``(Year, Word, Frequency)`` of the ``n`` most frequent stems of every year."""
    from .select import only_language
    counting = {k: options.pop(k) for k in ("stopwords", "min_length") if k in options}
    src = only_language(df, language) if language else df
    counts = word_counts(src.where(F.col(year).isNotNull()), [year], text=text, **counting)
    stems = stem_counts(counts, [year], **options)
    order = [F.col("Frequency").desc(), F.col("stem").asc()]
    return top_n(stems, [year], order, n).select(year, "Word", "Frequency")


def all_time_words(words_by_year: DataFrame, *, year: str = "Year") -> DataFrame:
    """``(Word, Frequency, Category)`` over all years, category of the first occurrence."""
    first = F.struct(F.col(year).alias("y"), (-F.col("Frequency")).alias("f"), F.col("Category").alias("c"))
    return words_by_year.groupBy("Word").agg(
        F.sum("Frequency").alias("Frequency"),
        F.coalesce(F.min_by("Category", first), F.lit("Other")).alias("Category"))


def word_cloud(words_table: DataFrame, n: int = 60, *, smallest: float = 12.0, largest: float = 55.0) -> DataFrame:
    """The ``n`` most frequent words with their font size on a square-root scale."""
    from pyspark.sql import Window
    top = words_table.orderBy(F.col("Frequency").desc(), "Word").limit(n)
    w = Window.partitionBy()  # at most n rows
    low, high = F.min("Frequency").over(w), F.max("Frequency").over(w)
    return top.withColumn("size", S.sqrt_scale("Frequency", low, high, smallest, largest))


# --- language ------------------------------------------------------------------

def language_text(text) -> Column:
    """The part of a lyric that language detection looks at."""
    return S.strip_blanks(S.strip_markers(text, ""))


def letters(text) -> Column:
    """The letters of a text in lower case, words one space apart."""
    return F.regexp_replace(F.lower(S.col(text)), r"[^\p{L}]+", " ")


def train_language_profiles(labelled: DataFrame, *, text: str = "text", language: str = "lang",
                            size: int | None = None) -> DataFrame:
    """``(lang, gram, weight)``: the character triples of every language, or only the ``size`` commonest.

    The weight is a whole-number log probability above a fixed floor, so that
    scores add up exactly in any order. The texts are counted when this is called.
    """
    known = labelled.where(F.col(language).isNotNull())
    counts = tallies(known, F.col(language), letters(text), kind="trigrams").select(F.col("label").alias("lang"), F.col("piece").alias("gram"), "n")
    counts = stored(counts)  # read twice; a row per triple and language
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    best = counts if size is None else top_n(counts, ["lang"], [F.col("n").desc(), F.col("gram")], size)
    weight = F.greatest(F.round(F.log(F.col("n") / F.col("total") * 1e6) * 1000), F.lit(0.0))
    return best.join(totals, "lang").select("lang", "gram", weight.cast("bigint").alias("weight"))


def leading(scores: Column) -> Column:
    """The label with the greatest score, the alphabetically first of equals; NULL without any."""
    return F.array_min(F.transform(scores, lambda s: F.struct((-s["score"]).alias("less"), s["label"].alias("label"))))["label"]


def label_language(df: DataFrame, profiles: DataFrame, *, key: str, text: str = "Lyrics", default: str = "en",
                   min_length: int = 30) -> DataFrame:
    """``(key, language)`` of every row: the likeliest language by trigrams, for any number of languages.

    Blank, ``'0'`` and short texts, and texts without a known trigram, get the
    default. Texts are scored in the task that read them.
    """
    zero = F.rlike(S.col(text), F.lit(r"^[\s\p{Z}]*0[\s\p{Z}]*\z"))

    def usable(cleaned: Column) -> Column:
        return F.when(~S.is_blank(text) & ~zero & (F.length(cleaned) >= min_length), letters(cleaned))
    model = profiles.select(F.col("gram").alias("piece"), F.col("lang").alias("label"), "weight")
    found = scored(df, [key], S.bound(language_text(text), usable), model, kind="trigrams")
    return found.select(key, F.coalesce(leading(F.col("scores")), F.lit(default)).alias("language"))


# --- sentiment --------------------------------------------------------------------

def sentiment(df: DataFrame, lexicon: DataFrame, *, key: str, text: str = "Lyrics", alpha: float = 15.0) -> DataFrame:
    """``(key, Sentiment_Score)`` of every row, in [-1, 1], from a ``(word, weight)`` table.

    The summed weights s of a text become s / sqrt(s^2 + alpha) with four
    decimals (Hutto & Gilbert 2014); texts without a listed word score 0.
    """
    model = lexicon.groupBy(F.col("word").alias("piece")).agg(F.max("weight").alias("weight")).withColumn("label", F.lit(""))
    found = scored(df, [key], spaced_words(text), model, kind="words")
    s = F.coalesce(F.get("scores", F.lit(0))["score"], F.lit(0.0))
    return found.select(key, F.round(s / F.sqrt(s * s + alpha), 4).alias("Sentiment_Score"))


# --- readability --------------------------------------------------------------------

def text_metrics(df: DataFrame, text: str = "Lyrics") -> DataFrame:
    """Add word and sentence numbers, grade level, type-token ratio and mean word length.

    Definitions: grade 0.39 words/sentence + 11.8 syllables/word - 15.59
    (Kincaid 1975); distinct words / words; characters / words. A sentence ends
    at a run of ``. ! ?`` or at a line end. NULL for texts without words.
    """
    cleaned = S.strip_markers(text)
    sentences = F.regexp_count(F.concat(cleaned, F.lit(".")), F.lit(r"[^\s.!?][^.!?\n]*[.!?\n]"))
    one_spaced = F.btrim(F.regexp_replace(S.punctuation_to_space(F.lower(cleaned)), r"\s+", " "))
    out = once(df, __t=one_spaced, n_sentences=sentences)
    out = once(out, __w=F.array_remove(F.split("__t", " "), ""),
               __p=F.regexp_replace(F.concat("__t", F.lit(" ")), "([a-z]{2})e ", "$1 "))
    out = once(out, n_words=F.size("__w"), __vowel_groups=F.regexp_count("__p", F.lit("[aeiouy]+")),
               __with_vowel=F.regexp_count("__p", F.lit("[aeiouy][^ ]*")),
               __kinds=F.size(F.array_distinct("__w")), __chars=F.length(F.replace("__t", F.lit(" "), F.lit(""))))
    n, m = F.col("n_words"), F.greatest(F.col("n_sentences"), F.lit(1))
    out = out.withColumn("n_syllables", F.col("__vowel_groups") + n - F.col("__with_vowel"))
    grade = 0.39 * F.try_divide(n, m) + 11.8 * F.try_divide(F.col("n_syllables"), n) - 15.59
    return out.select(
        *df.columns, "n_words", "n_sentences", "n_syllables", grade.alias("Flesch_Kincaid_Grade"),
        F.try_divide(F.col("__kinds"), n).alias("Lexical_Diversity"),
        F.try_divide(F.col("__chars"), n).alias("Avg_Word_Length"))
