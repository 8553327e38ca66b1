"""Planted passages, re-parameterised questions, and a plain version."""

import re

from reelrank.llm import decontam

ITEM = "A train leaves Boston at 9 h and travels 120 km before it meets the second train that left Denver at 7 h."
OTHER = "If Alice buys three apples for 5 dollars and sells them to Bob for 8 dollars how much does Alice earn in the end"
THIRD = "when Alice meets Bob then Alice pays Bob what Alice owes Bob in the shop of the old town"
BENCH = "item_id long, text string"


def found(frame, docs, bench, **kw):
    got = decontam.contaminated(frame(docs), frame(bench, BENCH), **kw)
    return sorted((r["doc_id"], r["item_id"]) for r in got.collect())


def test_exact_reparameterised_and_inconsistent(frame, sentence):
    pad = [sentence(i, 80) for i in range(6)]
    new = ITEM.replace("Boston", "Paris").replace("Denver", "Rome").replace("120", "85").replace("9 h", "11 h").replace("7 h", "4 h")
    names = iter(["Carol", "Dora", "Eve", "Finn", "Gus", "Hal"])
    swapped = re.sub("Alice|Bob", lambda m: next(names), THIRD)
    consistent = OTHER.replace("Alice", "Carol").replace("Bob", "Eve").replace("5 dollars", "3 dollars").replace("8 dollars", "9 dollars")
    docs = [(1, f"{pad[0]} {ITEM} {pad[1]}"), (2, f"{pad[2]}\n{new}\n{pad[3]}"), (3, pad[4]), (4, f"{pad[5]} {consistent}"),
            (5, f"{pad[5]} {swapped}"), (6, ITEM[:40]), (7, None), (8, ""), (9, ITEM.upper()[:0])]
    got = found(frame, docs, [(10, ITEM), (11, OTHER), (14, THIRD), (12, None), (13, "too short"), (None, OTHER), (10, ITEM)])
    assert (1, 10) in got and (2, 10) in got and (4, 11) in got
    assert not {d for d, _ in got} & {3, 6, 7, 8, 9}
    assert (5, 14) not in got  # the template, but each slot is filled anew each time


def test_multi_word_names_and_units(frame):
    item = "The Big River Company in New York ships 40 kg of sugar each week to the shops of the old town"
    doc = "The Small Lake Trading Group in Rome ships 75 kg of sugar each week to the shops of the old town"
    assert found(frame, [(1, doc)], [(1, item)]) == [(1, 1)]


def test_repeated_rows_null_ids_and_long_text(frame, sentence):
    long = sentence(1, 30_000) + " " + ITEM
    docs = [(1, long), (1, long), (None, ITEM), (2, ITEM)]
    got = decontam.contaminated(frame(docs), frame([(10, ITEM)], BENCH)).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == [(1, 10), (2, 10), (None, 10)]


def test_clean_keeps_columns_and_handles_empty_tables(spark, frame):
    docs = spark.createDataFrame([(1, ITEM, "x"), (2, "nothing here", "y"), (None, "nothing", "z")],
                                 "doc_id long, text string, _dirty string")
    kept = decontam.clean(docs, frame([(10, ITEM)], BENCH))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(2, "nothing here", "y"), (None, "nothing", "z")]
    assert decontam.contaminated(frame([]), frame([(10, ITEM)], BENCH)).count() == 0
    assert decontam.contaminated(frame([(1, ITEM)]), frame([], BENCH)).count() == 0


def brute(docs, bench, threshold=0.8):
    """Windows of five template tokens by plain Python, without slot checks."""
    pattern = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*|[A-ZÉÈÄÖÜÍÓÑ][^\W\d_]*(?: [A-ZÉÈÄÖÜÍÓÑ][^\W\d_]*)*|[^\W\d_]+|[%$€£°]")

    def template(text):
        out, raw = [], pattern.findall(text or "")
        for i, t in enumerate(raw):
            unit = t in decontam.UNITS and i and raw[i - 1][0].isdigit()
            out.append("<n>" if t[0].isdigit() else "<u>" if unit else "<a>" if t != t.lower() else t)
        return out

    pairs = set()
    items = {}
    for item, text in bench:
        t = template(text)
        w = {i: tuple(t[i:i + 5]) for i in range(len(t) - 4) if sum(not x.startswith("<") for x in t[i:i + 5]) >= 2}
        items[item] = w
    for doc, text in docs:
        t = template(text)
        where = {}
        for i in range(len(t) - 4):
            where.setdefault(tuple(t[i:i + 5]), []).append(i)
        for item, w in items.items():
            diagonals = {}
            for i, key in w.items():
                for d in where.get(key, ()):
                    diagonals[d - i] = diagonals.get(d - i, 0) + 1
            if w and max(diagonals.values(), default=0) / len(w) >= threshold:
                pairs.add((doc, item))
    return pairs


def test_given_tables_equal_plain_version(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert got and got == want


def test_main_path_is_native(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    plan = decontam.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_inserted_deleted_and_refilled_words(frame, sentence):
    words = (ITEM + " Then the Bank of America paid $5 for each of the tickets that were sold on the way to the coast by the sea").split()
    item, at = " ".join(words), len(words) // 2
    edits = {
        1: " ".join(words[:at] + ["really"] + words[at:]),
        2: " ".join(words[:at] + words[at + 1:]),
        3: item.replace("Bank of America", "Google"),
        4: item.replace("$5", "5 dollars"),
        5: item.lower(),
        6: item.upper(),
        7: " ".join(words[:at] + ["really"] + words[at:]).lower(),
    }
    docs = [(k, f"{sentence(k, 60)}. {text} {sentence(50 + k, 60)}") for k, text in edits.items()]
    far = " ".join(words[:at]) + " " + sentence(80, 300) + " " + " ".join(words[at:])
    assert found(frame, [*docs, (8, far), (9, " ".join(words[:at]))], [(1, item)]) == [(k, 1) for k in edits]


def test_clean_tells_rows_of_one_id_apart(frame):
    docs = [(None, ITEM), (None, "nothing here"), (None, None), (1, ITEM), (1, "nothing there"), (1, ITEM)]
    kept = decontam.clean(frame(docs), frame([(10, ITEM)], BENCH))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([docs[1], docs[2], docs[4]], key=str)
