import math

from pyspark.sql import functions as F

from trackstats.functions import scalars as S
from porter_by_word import stem_word
from trackstats.functions.stem import porter


def test_numbers(values):
    assert values([("1,234",), (" 7 ",), ("1e3",), ("",), ("7d",)], "s string", S.coerce_number("s")) == [0, 7, 1000, 0, 0]
    assert values([("12abc",), ("abc",), (" 7.5e1x",), ("-.5",)], "s string", S.prefix_float("s")) == [12, None, 75, -0.5]
    assert values([("1,234,567",), ("12.5",), ("x",), (" 9 ",)], "s string", S.grouped_int("s")) == [1234567, None, None, 9]
    assert values([("2010.0",), ("2011",), ("x",)], "s string", S.as_int("s")) == [2010, 2011, None]
    assert values([(3.0, 1.0, 5.0), (2.0, 2.0, 2.0)], "v double, a double, b double",
                  S.min_max("v", F.col("a"), F.col("b"))) == [0.5, 0.0]
    assert values([(90000,), (0,), (-5,)], "ms int", S.minutes("ms")) == [1.5, 0.0, 0.0]


def test_duration(values):
    rows = [(3.75,), (4.0,), (3.999,)]
    assert values(rows, "m double", S.duration_text("m")) == ["3.45", "4.00", "3.60"]
    assert values(rows, "m double", S.duration_text("m", carry=True)) == ["3.45", "4.00", "4.00"]


def test_artist_and_title(values):
    rows = [("AB",), ("A - B - C",), (" A  -  B ",)]
    assert values(rows, "s string", S.artist_part("s"), S.title_part("s")) == [("AB", ""), ("A", "B - C"), ("A", "B")]
    back = S.backfill_title("t", "s")
    assert values([("AB", None), ("A - B", " "), ("A - B", "kept"), (None, "")], "s string, t string", back) == ["AB", "B", "kept", ""]


def test_urls(values):
    rows = [("https://x/track/5Hi?x",), ("a" * 22,), ("zz",), ("a/" + "b" * 20,)]
    assert values(rows, "u string", S.id_from_url("u")) == ["5Hi", "a" * 22, None, None]
    assert values([("h/track/1/track/2",), ("none",)], "u string", S.embed_url("u")) == ["h/embed/track/1/track/2", "none"]


def test_text_cleaning(values):
    assert values([("a [x] b",), ("[a\nb] c",)], "t string", S.strip_markers("t")) == ["a   b", "[a\nb] c"]
    assert values([("Étion café d!",)], "t string", S.punctuation_to_space("t")) == ["Étion café d "]
    assert values([("[Chorus] It's ON, now_1 ",), ("",), (None,)], "t string", S.lyric_tokens("t")) == [
        ["it", "s", "on", "now_1"], [], None]
    assert values([("a\r\n\nb",)], "t string", S.collapse_newlines("t")) == ["a b"]
    assert values([("\"*Love.\"",)], "t string", S.trim_chars("t")) == ["Love"]
    assert values([("abcdef",)], "t string", S.prefix("t", 3)) == ["abc"]


def test_labels(values):
    rows = [("**grief AND loss**",), ("something else.",), ("Unrequited love, Missing Someone",)]
    assert values(rows, "t string", S.canonical_label("t")) == ["Grief and Loss", "something else", "Unrequited Love"]
    assert values([("A b!",), ("",), (None,)], "t string", S.slug("t")) == ["a-b-", "unknown", "unknown"]
    assert values([("duration_min",), ("Avg_Word_Length",), ("MC_x",)], "t string", S.title_label("t")) == [
        "Duration (min)", "Avg Word Length", "MC X"]
    assert values([("Danceability",), ("Tempo",)], "t string", S.short_label("t")) == ["Dance.", "Tempo"]
    assert values([("abcdefgh",), ("abc",)], "t string", S.abbreviate("t", 5)) == ["abc...", "abc"]


def test_formats(values):
    rows = [("tempo", 119.6), ("loudness", -5.25), ("duration_min", 3.5)]
    assert values(rows, "f string, v double", S.feature_text("f", "v")) == ["120", "−5.25", "3.30"]
    assert values([(120.4, 250.0), (0.5, 1.0)], "v double, m double", S.summary_text("v", F.col("m"))) == ["120", "0.50"]


def test_keys_and_geometry(values):
    assert values([(0, 1), (9, 0), (-1, 1), (None, 0)], "k int, m int", S.key_name("k", "m")) == ["C", "Am", None, None]
    assert values([(5,)], "k int", S.relative_minor("k")) == [2]
    x, y = S.polar_point("k", "s", 10.0)
    (px, py), = values([(3, 1.0)], "k int, s double", x, y)
    assert math.isclose(px, 10.0) and abs(py) < 1e-9
    assert values([(0.06,), (0.12,), (0.13,)], "d double", S.epanechnikov("d", 0.12)) == [
        0.75 * 0.75 / 0.12, 0.0, 0.0]
    rows = [(0.5, 0.5), (0.1, 0.9), (0.1, 0.1), (0.9, 0.1), (None, 0.1)]
    assert values(rows, "valence double, energy double", S.quadrant("valence", "energy")) == [
        "Euphoric Anthems", "Dark & Aggressive", "Melancholy Heartbreak", "Chill & Breezy", None]
    assert values([(4.0,)], "v double", S.sqrt_scale("v", 0, 16, 2, 22)) == [12.0]
    assert values([(5.0,)], "v double", S.sqrt_scale("v", 5, 5, 2, 22)) == [12.0]


# Examples from the published description of the algorithm, and the extensions.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "filing": "file", "happy": "happi", "sky": "sky", "enjoy": "enjoy", "relational": "relat", "rational": "ration",
    "digitizer": "digit", "radicalli": "radic", "vietnamization": "vietnam", "operator": "oper", "hopefulness": "hope",
    "sensibiliti": "sensibl", "triplicate": "triplic", "electrical": "electr", "goodness": "good", "revival": "reviv",
    "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "effective": "effect", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "died": "die", "dies": "die",
    "archaeology": "archaeolog", "is": "is",
}


def test_stemmer(spark):
    got = porter(spark.createDataFrame([(w,) for w in STEMS], "w string"), "w", "stem").collect()
    assert {r.w: r.stem for r in got} == STEMS == {w: stem_word(w) for w in STEMS}


def test_stemmer_of_all_kinds_of_words_equals_the_rules_word_by_word(spark):
    import random

    from trackstats.functions import stem
    rng = random.Random(1)
    ends = ["", "y", "yy", "yyy", "e", "ll", "ed", "ing", "ied", "ies", "alli", "s", *(x for x, _ in stem.PLURAL + stem.DERIVED + stem.QUALITY), *stem.RESIDUAL]
    words = {"".join(rng.choices("abcdeilnorstuvwxyz\u00e9", k=rng.randrange(7))) + rng.choice(ends) + rng.choice(["", "", "s", "ed", "ing", "ly"]) for _ in range(6000)}
    words |= {*stem.IRREGULAR, "", "a", "Yy", "SAYING", "yyyeah", "\U0001d49cing", "123s"}
    df = spark.createDataFrame([(w, 1) for w in words] + [(None, 2)], "w string, stem_of int")
    out = porter(df, "w", "stem")
    assert out.columns == ["w", "stem_of", "stem"] and "Python" not in out._jdf.queryExecution().executedPlan().toString()
    bad = [(r.w, r.stem, stem_word(r.w)) for r in out.collect() if r.w is not None and r.stem != stem_word(r.w)]
    assert not bad, bad[:5]
    assert out.where("w is null and stem is null").count() == 1
