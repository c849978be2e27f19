"""Word counts, stems, language, sentiment, readability and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab
from ..operators import enrich, evolution, labels, rank, select, text
from .feature_queries import rounded
from .inputs import COUNTS, LYRICS, STOPWORD_SQL, WORDS, WORDS_SQL, lyrics, table, words
from .porter_sql import STEMS
from .registry import query


@query(f"WITH {COUNTS} SELECT Year, word, n FROM counts")
def word_counts(spark, folder):
    return text.word_counts(select.only_language(lyrics(spark, folder)), ["Year"])


@query(f"WITH {WORDS} SELECT Year, Word, Frequency FROM words")
def top_words_per_year(spark, folder):
    return text.top_words(lyrics(spark, folder), 100, stem=None)


@query(f"""WITH {COUNTS}, {STEMS}, s AS (SELECT Year, stem, arg_min(c.word, (-n, c.word)) AS Word,
  CAST(sum(n) AS BIGINT) AS Frequency FROM counts c JOIN stems USING (word) GROUP BY ALL)
SELECT Year, stem, Word, Frequency FROM s""")
def stem_counts(spark, folder):
    counts = text.word_counts(select.only_language(lyrics(spark, folder)), ["Year"])
    return text.stem_counts(counts, ["Year"])


@query(f"""WITH {COUNTS}, {STEMS}, s AS (SELECT Year, stem, arg_min(c.word, (-n, c.word)) AS Word,
  CAST(sum(n) AS BIGINT) AS Frequency FROM counts c JOIN stems USING (word) GROUP BY ALL)
SELECT Year, Word, Frequency FROM s QUALIFY row_number() OVER (PARTITION BY Year ORDER BY Frequency DESC, stem) <= 100""")
def top_stems_per_year(spark, folder):
    return text.top_words(lyrics(spark, folder), 100)


LEMMA_SQL = "CASE WHEN length(word) > 5 AND word LIKE '%s' THEN left(word, length(word) - 1) ELSE word END"


@query(f"""WITH {COUNTS}, s AS (SELECT Year, {LEMMA_SQL} AS stem, arg_min(word, (-n, word)) AS Word,
  CAST(sum(n) AS BIGINT) AS Frequency FROM counts GROUP BY ALL) SELECT Year, stem, Word, Frequency FROM s""")
def lemma_counts(spark, folder):
    counts = text.word_counts(select.only_language(lyrics(spark, folder)), ["Year"])
    plural = (F.length("word") > 5) & F.endswith("word", F.lit("s"))
    lemmas = counts.where(plural).select("word", F.left("word", F.length("word") - 1).alias("lemma")).distinct()
    return text.stem_counts(counts, ["Year"], lemmas=lemmas, stem=None)


@query(f"""WITH {WORDS}, a AS (SELECT Word, CAST(sum(Frequency) AS BIGINT) AS Frequency,
  arg_min(Category, (Year, -Frequency)) AS Category FROM words GROUP BY Word),
t AS (SELECT * FROM a ORDER BY Frequency DESC, Word LIMIT 60), m AS (SELECT min(Frequency) AS lo, max(Frequency) AS hi FROM t)
SELECT Word, Frequency, Category, round((sqrt(Frequency) - sqrt(lo)) / (sqrt(hi) - sqrt(lo)) * 43 + 12, 6) AS size FROM t, m""")
def word_cloud_all_time(spark, folder):
    return rounded(text.word_cloud(text.all_time_words(words(spark, folder))), 6, "size")


@query(f"""WITH {WORDS} SELECT Word, Frequency FROM words WHERE Year = 2012 AND Category = 'Location'
ORDER BY Frequency DESC, Word LIMIT 60""")
def word_cloud_selection(spark, folder):
    chosen = select.Selection(year=2012, word_category="Location").words(words(spark, folder))
    return text.word_cloud(chosen).select("Word", "Frequency")


@query(f"""WITH {WORDS}, r AS (SELECT *, row_number() OVER (PARTITION BY Year, Category ORDER BY Frequency DESC, Word) AS pos
  FROM words) SELECT Year, Category, string_agg(concat(Word, ':', Frequency), ' ' ORDER BY pos) AS words
FROM r WHERE pos <= 7 GROUP BY ALL""")
def word_index_top7(spark, folder):
    index = rank.words_by_category(words(spark, folder), 7)
    entries = F.transform("words", lambda s: F.concat_ws(":", s["Word"], s["Frequency"].cast("string")))
    return index.select("Year", "Category", F.array_join(entries, " ").alias("words"))


@query(f"""WITH {LYRICS}, v AS (SELECT DISTINCT unnest({WORDS_SQL}) AS word FROM lyrics)
SELECT word FROM v WHERE word NOT IN (SELECT Artist FROM lyrics) AND word NOT IN ({STOPWORD_SQL})""")
def vocabulary_without_lists(spark, folder):
    ly = lyrics(spark, folder)
    listed = evolution.literal_table(spark, [(w,) for w in text.DEFAULT_STOPWORDS], ["word"])
    stop = text.merge_vocabularies(listed, ly.select(F.col("Artist").alias("word")))
    return text.word_counts(ly, [], stopwords=stop, min_length=0).select("word")


# --- language ---------------------------------------------------------------------

GRAMS_SQL = r"""list_transform(range(1, greatest(len(cs) - 1, 1)), lambda i: concat(cs[i], cs[i + 1], cs[i + 2]))"""


def _letters_sql(column: str) -> str:
    return rf"string_split(regexp_replace(lower({column}), '[^\p{{L}}]+', ' ', 'g'), '')"


LANGUAGE_SQL = rf"""{LYRICS}, tr AS (SELECT lang, {_letters_sql('text')} AS cs FROM documents),
g AS (SELECT lang, gram, count(*) AS n FROM (SELECT lang, unnest({GRAMS_SQL}) AS gram FROM tr) GROUP BY ALL),
tot AS (SELECT lang, sum(n) AS total FROM g GROUP BY lang),
prof AS (SELECT lang, gram, CAST(greatest(round(ln(n / total * 1e6) * 1000), 0) AS BIGINT) AS weight FROM g JOIN tot USING (lang)),
cl AS (SELECT doc_id, regexp_replace(regexp_replace(Lyrics, '\[[^\n]*?\]', '', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS c FROM lyrics),
dg AS (SELECT doc_id, unnest({GRAMS_SQL}) AS gram FROM (
  SELECT doc_id, {_letters_sql('c')} AS cs FROM cl WHERE length(c) >= 30)),
sc AS (SELECT doc_id, lang, sum(weight) AS score FROM dg JOIN prof USING (gram) GROUP BY ALL),
guess AS (SELECT l.doc_id, l.language AS lang, coalesce(s.language, 'en') AS language FROM lyrics l
LEFT JOIN (SELECT doc_id, arg_min(lang, (-score, lang)) AS language FROM sc GROUP BY doc_id) s ON l.doc_id = s.doc_id)"""


@query(f"WITH {LANGUAGE_SQL} SELECT doc_id, language FROM guess")
def language_guess(spark, folder):
    profiles = text.train_language_profiles(table(spark, folder, "documents"))
    return text.label_language(lyrics(spark, folder), profiles, key="doc_id")


@query(f"WITH {LANGUAGE_SQL} SELECT lang, language, count(*) AS n FROM guess GROUP BY ALL")
def language_accuracy(spark, folder):
    """Given against guessed language; the key repeats for every row of a language."""
    profiles = text.train_language_profiles(table(spark, folder, "documents"))
    keyed = lyrics(spark, folder).withColumnRenamed("language", "lang")
    return text.label_language(keyed, profiles, key="lang").groupBy("lang", "language").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang AS language FROM documents WHERE lang = 'de'")
def only_one_language(spark, folder):
    return select.only_language(lyrics(spark, folder), "de").select("doc_id", "language")


# --- sentiment, readability, topics --------------------------------------------------

# A small lexicon in tenths over words of the given documents.
LEXICON = [("the", 3), ("and", -2), ("der", 5), ("die", -4), ("que", 7), ("les", -6), ("los", 2), ("une", 9), ("for", -11)]
LEXICON_SQL = "lexicon(word, weight) AS (VALUES " + ", ".join(f"('{w}', {n})" for w, n in LEXICON) + ")"


@query(rf"""WITH {LYRICS}, {LEXICON_SQL}, t AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM lyrics),
s AS (SELECT doc_id, CAST(sum(weight) AS DOUBLE) AS s FROM t JOIN lexicon USING (word) GROUP BY doc_id)
SELECT l.doc_id, round(coalesce(s.s, 0) / sqrt(coalesce(s.s, 0) * coalesce(s.s, 0) + 15), 4) AS Sentiment_Score
FROM lyrics l LEFT JOIN s ON l.doc_id = s.doc_id""")
def sentiment_scores(spark, folder):
    lexicon = evolution.literal_table(spark, LEXICON, ["word", "weight"])
    return text.sentiment(lyrics(spark, folder), lexicon, key="doc_id")


@query(rf"""WITH {LYRICS}, {LEXICON_SQL}, t AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM lyrics),
s AS (SELECT doc_id, CAST(sum(weight) AS DOUBLE) AS s FROM t JOIN lexicon USING (word) GROUP BY doc_id)
SELECT CASE WHEN language <> 'de' THEN Artist END AS Artist,
  round(coalesce(s.s, 0) / sqrt(coalesce(s.s, 0) * coalesce(s.s, 0) + 15), 4) AS Sentiment_Score
FROM lyrics l LEFT JOIN s ON l.doc_id = s.doc_id""")
def sentiment_repeated_keys(spark, folder):
    """Every row its own score, though the key repeats and is partly NULL."""
    lexicon = evolution.literal_table(spark, LEXICON, ["word", "weight"])
    keyed = lyrics(spark, folder).withColumn("Artist", F.when(F.col("language") != "de", F.col("Artist")))
    return text.sentiment(keyed, lexicon, key="Artist")


@query(rf"""WITH {LYRICS}, w AS (SELECT doc_id, {WORDS_SQL} AS ws, len(regexp_extract_all(concat(
    regexp_replace(Lyrics, '\[[^\n]*?\]', ' ', 'g'), '.'), '[^\s.!?][^.!?\n]*[.!?\n]')) AS n_sentences FROM lyrics),
p AS (SELECT *, len(ws) AS n, regexp_replace(concat(array_to_string(ws, ' '), ' '), '([a-z]{{2}})e ', '\1 ', 'g') AS padded FROM w),
y AS (SELECT *, len(regexp_extract_all(padded, '[aeiouy]+')) + n - len(regexp_extract_all(padded, '[aeiouy][^ ]*')) AS syl FROM p)
SELECT doc_id, CAST(n AS INT) AS n_words, CAST(n_sentences AS INT) AS n_sentences, CAST(syl AS INT) AS n_syllables,
  round(0.39E0 * (n / greatest(n_sentences, 1)) + 11.8E0 * (syl / nullif(n, 0)) - 15.59E0, 4) AS Flesch_Kincaid_Grade,
  round(len(list_distinct(ws)) / nullif(n, 0), 6) AS Lexical_Diversity,
  round(length(array_to_string(ws, '')) / nullif(n, 0), 6) AS Avg_Word_Length FROM y""")
def text_metrics(spark, folder):
    out = text.text_metrics(lyrics(spark, folder)).select(
        "doc_id", "n_words", "n_sentences", "n_syllables", "Flesch_Kincaid_Grade", "Lexical_Diversity", "Avg_Word_Length")
    return rounded(rounded(out, 4, "Flesch_Kincaid_Grade"), 6, "Lexical_Diversity", "Avg_Word_Length")


TOPIC_CHAIN = " ".join(f"WHEN contains(lower(t), '{v.lower()}') THEN '{v}'" for v in vocab.TOPICS)


@query(f"""WITH a AS (SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE text END AS text,
  CASE WHEN lang = 'fr' THEN concat('"*', source, '. ') ELSE
    concat('**', upper(list_extract([{", ".join(f"'{v}'" for v in vocab.TOPICS)}], 1 + n_chars % 43)), '.', text) END AS raw FROM documents)
SELECT doc_id, CASE WHEN text = '' THEN 'Other' ELSE CASE {TOPIC_CHAIN} ELSE t END END AS Topic
FROM (SELECT *, trim(raw, '''"*.-[] ') AS t FROM a)""")
def topic_canonicalise(spark, folder):
    names = F.array(*[F.lit(v) for v in vocab.TOPICS])
    d = table(spark, folder, "documents")
    picked = F.upper(F.element_at(names, (F.col("n_chars") % 43 + 1).cast("int")))
    raw = F.when(F.col("lang") == "fr", F.concat(F.lit('"*'), "source", F.lit(". "))).otherwise(
        F.concat(F.lit("**"), picked, F.lit("."), "text"))
    answered = d.select("doc_id", F.when(F.col("lang") == "de", "").otherwise(F.col("text")).alias("Lyrics"), raw.alias("raw"))
    return enrich.finish_topics(answered, "raw").select("doc_id", "Topic")


OPENING = r"^[^\s]+ [^\s]+"


@query(rf"""WITH lab AS (SELECT regexp_extract(lower(text), '{OPENING}') AS label, min(doc_id) AS place FROM documents
  WHERE text IS NOT NULL GROUP BY 1 HAVING label <> ''),
hit AS (SELECT d.doc_id, arg_min(label, place) AS label FROM documents d JOIN lab ON contains(lower(d.text), label) GROUP BY d.doc_id)
SELECT d.doc_id, label FROM documents d LEFT JOIN hit USING (doc_id)""")
def first_of_many_labels(spark, folder):
    """The first two words of every text are a label; each text has the earliest label that it contains."""
    d = table(spark, folder, "documents")
    opening = F.regexp_extract(F.lower("text"), OPENING, 0)
    found = d.groupBy(opening.alias("label")).agg(F.min("doc_id").alias("place"))
    return labels.first_label(d, ["doc_id"], F.col("text"), found)


TOPIC_LIST = "[" + ", ".join(f"'{v}'" for v in vocab.TOPICS) + "]"


@query(f"""SELECT doc_id, CASE {TOPIC_CHAIN} END AS Topic FROM (
  SELECT doc_id, list_extract({TOPIC_LIST}, 1 + n_chars % {len(vocab.TOPICS)}) AS t FROM documents)""")
def classified_topics(spark, folder):
    """A batch function sees a bounded prompt of every text; its raw answers end in marks and line ends."""
    def answer(batches):
        for b in batches:
            names = [vocab.TOPICS[n % len(vocab.TOPICS)] for n in b["n_chars"]]
            yield b[["doc_id"]].assign(Lyrics=b["prompt"], raw=[f'"{t.upper()} **' + chr(10) for t in names])

    prompt = S.prefix(F.concat(F.lit("Song: "), "text"), 500).alias("prompt")
    asked = table(spark, folder, "documents").select("doc_id", "n_chars", prompt)
    answered = enrich.classify(asked, answer, "doc_id long, Lyrics string, raw string")
    return enrich.finish_topics(answered, "raw").select("doc_id", "Topic")


# Keywords over words of the given documents.
KEYWORDS = [("the", "Dancing Anthem", 1), ("and", "Grief and Loss", 2), ("der", "Coming of Age", 2),
            ("que", "Missing Someone", 3), ("les", "Coming of Age", 3)]
KEYWORD_SQL = "kw(word, topic, weight) AS (VALUES " + ", ".join(f"('{w}', '{t}', {n})" for w, t, n in KEYWORDS) + ")"


@query(f"""WITH {LYRICS}, {KEYWORD_SQL}, t AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM lyrics),
s AS (SELECT doc_id, topic, sum(weight) AS score FROM t JOIN kw USING (word) GROUP BY ALL)
SELECT l.doc_id, s.Topic FROM lyrics l LEFT JOIN (
  SELECT doc_id, arg_min(topic, (-score, topic)) AS Topic FROM s GROUP BY doc_id) s ON l.doc_id = s.doc_id""")
def keyword_topics(spark, folder):
    keywords = evolution.literal_table(spark, KEYWORDS, ["word", "topic", "weight"])
    return enrich.keyword_topics(lyrics(spark, folder), keywords, key="doc_id")


@query(r"""SELECT conv_id, turn, regexp_replace(text, '[\r\n]+', ' ', 'g') AS text FROM conversations""")
def newline_collapse(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", S.collapse_newlines("text").alias("text"))
