import random

import numpy as np

from trackstats.llm import decontaminate as D

ITEMS = [
    (1, "A train leaves Boston at 9 and covers 120 km before it stops. After 3 hours it meets Alice Smith near Boston again."),
    (2, "What is the boiling point of water at sea level on an ordinary day"),
    (3, "short one"), (4, None), (5, ""), (None, "an item without any number or identity of its own here"),
    (6, "12 13 14 15 16 17 18 19 20 21"),
    (7, "What is the boiling point of water at sea level on an ordinary day"),
]


def filler(rng, n):
    return " ".join("".join(rng.choices("bcdfglmnprstaeiou", k=6)) for _ in range(n))


def find(spark, docs, items=tuple(ITEMS)):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string, span string").repartition(3)
    b = spark.createDataFrame([(*i[:2], "") for i in items], "item_id long, text string, coverage string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(d, b).collect()}


def test_copies_and_exchanged_values(spark):
    rng = random.Random(4)
    swapped = ITEMS[0][1].replace("Boston", "Denver").replace("120", "75.5").replace("9", "11").replace("Alice Smith", "Bob Jones")
    mixed = ITEMS[0][1].replace("leaves Boston", "leaves Denver")  # Boston stands for two values
    docs = [
        (10, f"{filler(rng, 50)} {ITEMS[0][1]} {filler(rng, 50)}"), (11, f"{filler(rng, 20)} {swapped} {filler(rng, 9)}"),
        (12, f"{filler(rng, 9)}\n{ITEMS[1][1].upper().lower()}, {filler(rng, 9)}"), (13, filler(rng, 200)),
        (14, None), (15, ""), (16, "numbers 12 13 14 15 16 17 18 19 20 21 stand here"),
        (17, "numbers 32 33 34 35 36 37 38 39 40 41 stand here"), (18, "a short one ends"),
        (19, "What is the boiling point of lead"), (None, ITEMS[1][1]), (20, f"{filler(rng, 5)}. {mixed}"),
        (21, " ".join([filler(rng, 30_000), ITEMS[1][1], filler(rng, 100)])), (10, "a second row of the same document")]
    got = find(spark, [(*d, "x", "y") for d in docs])
    assert set(got) == {(10, 1), (11, 1), (12, 2), (12, 7), (16, 6), (18, 3), (20, 1), (21, 2), (21, 7)}
    assert got[10, 1].same_values and not got[11, 1].same_values
    assert all(0.5 <= r.coverage <= 1 for r in got.values())


def test_inconsistent_values_do_not_match(spark):
    item = [(1, "take 3 boxes and add 3 more boxes until there are 6 boxes on 3 shelves", "")]
    ok = "take 5 boxes and add 5 more boxes until there are 9 boxes on 5 shelves"
    bad = "take 5 boxes and add 4 more boxes until there are 9 boxes on 8 shelves"
    got = find(spark, [(1, ok, "", ""), (2, bad, "", "")], item)
    assert set(got) == {(1, 1)}


def test_every_planted_item_and_no_other(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [r.text for r in bench.collect()]
    want = {r.doc_id for r in docs.collect() if any(i in r.text for i in items)}
    assert {r.doc_id for r in D.op1_benchmark_leaks(spark, folder).collect()} == want
    left = D.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some words to look at here and there again")], "doc_id long, text string")
    assert D.leaking_documents(docs, bench).count() == 0
    assert D.leaking_documents(one, bench).count() == 0 and D.without_leaks(one, bench).count() == 1


TOM = "Tom has 5 apples. Tom buys 3 more. Tom eats 2. Tom then gives 4 to a friend of Tom"
CAR = "A car drives 120 km in 2 hours and then 60 km more in 1 hour until it stops"


def test_names_at_sentence_starts_case_and_many_numbers(spark):
    rng = random.Random(9)
    items = [(1, TOM), (2, TOM.removesuffix(" of Tom")), (3, "What is the capital of France?"), (4, CAR),
             (5, "We met Alice Smith in Boston. She said that Boston was her favourite town by far."), (6, "7 8 9 10 11 12 13 14 15")]
    docs = [(10, f"{filler(rng, 9)}. {TOM.replace('Tom', 'Bob').replace('5', '8')} {filler(rng, 9)}"),
            (11, f"they asked {items[2][1]} and left"), (12, f"they asked {items[2][1].lower()} and left"),
            (13, f"{filler(rng, 30)} {items[4][1].lower()} {filler(rng, 3)}"),
            (14, CAR.replace("120", "95").replace("60", "40").replace("2 hours", "3 hours")), (15, CAR.replace("km", "miles")),
            (16, CAR.replace("60 km", "60 miles") + " and waits"),  # one unit stands for two: six of eleven windows are gone
            (17, "17 18 19 20 21 22 23 24 25"), (18, "A cat eats 2 kg in 3 days and a dog eats 4 kg in 5 days until it sleeps")]
    got = find(spark, [(*d, "x", "y") for d in docs], items)
    assert set(got) == {(10, 1), (10, 2), (11, 3), (12, 3), (13, 5), (14, 4), (15, 4)}
    assert {k for k, r in got.items() if r.same_values} >= {(11, 3), (12, 3), (13, 5)}
    assert not any(got[k].same_values for k in ((10, 1), (10, 2), (14, 4), (15, 4)))


def test_a_minority_value_costs_its_windows_only():
    window = lambda p, here, there: (p, p, here, there)
    kept, same = D.consistent([window(0, [7, 0], [9, 0]), window(5, [7, 0], [9, 0]), window(9, [7, 0], [3, 0]), window(12, [0, 5], [0, 5])])
    assert kept == {(0, 0), (5, 5), (12, 12)} and not same
    assert D.consistent([window(0, [7], [9]), window(3, [7], [3])]) == (set(), True)
    assert D.consistent([window(0, [7], [7]), window(3, [7], [3])]) == ({(0, 0)}, True)


def brute(docs, items):
    """All windows of all items against all windows of all documents, by their words."""
    out = {}
    seqs = {}
    for key, text in [*docs, *items]:
        seqs[key, text] = D.sequences([(text or "").encode()])
    for item, it in items:
        for doc, dt in docs:
            for kind in range(3):
                a, b = seqs[item, it][kind], seqs[doc, dt][kind]
                n = len(a.value)
                width = min(n, D.WINDOW)
                if not n:
                    continue
                few = D.PLAIN_WORDS if width == D.WINDOW else min(D.SHORT_PLAIN_WORDS, width)

                def shape(s, i, width=width, few=few):
                    exact = (~s.slot[i:i + width]).sum() < few
                    return exact, tuple((s.value if exact else s.template)[i:i + width])
                places = range(n - width + 1)
                there = {}
                for j in range(len(b.value) - width + 1):
                    there.setdefault(shape(b, j), []).append(j)
                by_shift = {}
                for i in places:
                    for j in there.get(shape(a, i), []):
                        cells = [np.where(s.slot[p:p + width], s.value[p:p + width], 0).tolist() for s, p in ((a, i), (b, j))]
                        by_shift.setdefault(j - i, []).append((i, 0, *cells))
                kept = set().union(*[D.consistent(w)[0] for w in by_shift.values()]) if by_shift else set()
                if len(kept) >= D.COVERAGE * len(places):
                    out[doc, item] = max(out.get((doc, item), 0), len(kept) / len(places))
    return out


def test_equals_brute_force_over_all_windows(spark):
    rng = random.Random(2)
    names, verbs = ["Tom", "Alice Smith", "Bob", "Boston"], ["buys", "sells", "eats", "walks"]

    def sentence():
        return f"{rng.choice(names)} {rng.choice(verbs)} {rng.randrange(30)} {rng.choice(['km', 'apples', 'kg'])} {rng.choice(['in', 'and'])} {rng.choice(names)}" \
               f" {rng.choice(verbs)} {rng.choice(['one', '2', '7.5'])} more{rng.choice(['. ', ' and ', ', '])}"
    items = [(i, "".join(sentence() for _ in range(rng.randrange(1, 4)))) for i in range(12)]
    docs = []
    for i in range(60):
        text = rng.choice(items)[1] if i % 2 else "".join(sentence() for _ in range(3))
        for old in rng.sample([*names, "2", "km"], 2):
            text = text.replace(old, rng.choice(["Eve", "Denver", "5", "miles"]), rng.randrange(3))
        docs.append((100 + i, f"{filler(rng, 3)} {text}{filler(rng, 3)}"))
    got = find(spark, [(*d, "", "") for d in docs], [(*i, "") for i in items])
    want = brute(docs, items)
    assert len(want) > 20 and {k: round(r.coverage, 9) for k, r in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_columns_of_clashing_names_stay(spark):
    docs = spark.createDataFrame([(1, "what is the capital of France", 7, "k", 0.5), (2, "other text", 8, "l", 0.1)],
                                 "doc_id long, text string, item_id long, kind string, coverage double")
    bench = spark.createDataFrame([(5, "What is the capital of France?", 1)], "item_id long, text string, doc_id long")
    assert [tuple(r) for r in D.without_leaks(docs, bench).collect()] == [(2, "other text", 8, "l", 0.1)]
