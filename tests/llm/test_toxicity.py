"""The grammar's clauses, the composed machine against a plain version, and held-out accuracy on the given labels."""

import random
import zlib

import numpy as np
import pytest

from reelrank.llm import toxicity
from reelrank.llm.toxicity import Grammar


def total(text):
    return sum(s for _, s in Grammar().clauses(text)[0])


def test_modifiers_change_a_clause():
    plain = total("the man is an idiot")
    assert total("you are such an idiot") > plain > total("the man is not an idiot")
    assert plain > total("somebody said the man is an idiot")
    assert total("he is no idiot. the man is an idiot") > plain  # a clause ends a scope
    assert total("a perfectly pleasant afternoon") == 0


def test_threats_need_somebody_who_means_them_and_a_target():
    assert total("I will kill you") > 2 > total("we kill the process and start it again")
    assert total("I will not kill you") < 1 and total("she said I will kill you") < 1
    assert total("I beat the eggs while the oven warms up and then call you") < 0.5


def plain_total(symbols):
    """Score of a clause by looking back and ahead instead of through states."""
    def within(i, kinds, n):
        return any(symbols[j][0] in kinds for j in range(max(0, i - n), i))

    factors, score, threats = toxicity.FACTORS, 0.0, {}
    for i, (s, weight) in enumerate(symbols):
        if s not in "IT":
            continue
        part = weight * (factors["-"] if within(i, "N", 3) else 1) * (factors["'"] if within(i, "R", i) else 1)
        if s == "I":
            part *= (factors["="] if within(i, "C", 3) else 1) * (factors["+"] if within(i, "UY", 4) else 1)
        else:
            part *= toxicity.TRACE
            if within(i, "F", 4):
                part *= factors["!"]
                threats[i] = part
        score += part
    for i, part in threats.items():
        behind = [s for s, _ in symbols[i + 1:i + 4]]
        before_next = behind[:behind.index("T")] if "T" in behind else behind
        score += toxicity.COMPLETED * part if "U" in before_next else 0
    return score


def test_the_composition_equals_a_plain_version():
    chance, machine = random.Random(4), toxicity.Composition()
    for _ in range(4000):
        symbols = [(chance.choice("ITUYFCNR....."), chance.random()) for _ in range(chance.randrange(0, 14))]
        assert machine.total(symbols) == pytest.approx(plain_total(symbols))


PROSE = [
    "The committee discussed the distance between the two districts and the cost of travel by train.",
    "On our day out we discovered a traditional transport museum, a worthy pathway and a cloakroom full of trams.",
    "Der Ausschuss besprach die Entfernung zwischen den Bezirken und die Kosten der Reise, sachlich und ohne Streit.",
    "Le comité a discuté de la distance entre les districts; nous vous écrirons demain, ne soyez pas inquiets.",
    "El comité habló de la distancia entre los distritos y del precio del viaje; no es un trabajo difícil.",
    "I will beat the eggs, then you hang the coats and we crush the garlic.",
]


def test_ordinary_prose_passes_and_the_factors_decide(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.fit(docs, labels)

    def toxic(text):
        return bool(grammar.score(np.array([grammar.features(text)[:3]]))[0] >= toxicity.THRESHOLD)

    assert not any(toxic(t) for t in PROSE)
    assert toxic("The man is an idiot.") and not toxic("The man is not an idiot.")
    assert toxic("I will kill you.") and not toxic("He wrote that I will kill you.")
    grammar._chain = toxicity.Composition(dict.fromkeys(toxicity.FACTORS, 1.0))
    assert toxic("The man is not an idiot.")  # without the factors the same clause is rejected
    # most frequent words of toxic documents are whole words; their beginnings are no patterns
    assert not {"dis^", "diso^", "trav^", "wort^", "worth^", "path^", "clow^"} & set(grammar.weights)


def test_a_beginning_needs_evidence_of_its_own():
    def row(pattern, p, n):
        return pattern, p, n, 50.0, 5.0

    kept = toxicity._own_evidence([row("=scum", 90, 0), row("vequa^", 40, 0), row("vequ^", 41, 1), row("lost^", 80, 2),
                                   row("lostra^", 40, 1)], 300, 3000)
    assert set(kept) == {"=scum", "vequa^", "lostra^", "lost^"}


def test_only_matched_clauses_are_scored():
    found, words = Grammar().clauses("A fine day. What an IDIOT!\nAll is well; total scum here")
    assert [c for c, _ in found] == ["what an idiot", "total scum here"] and words > 10
    assert Grammar().clauses("idiot")[0] and Grammar().clauses("...idiot...")[0]
    assert Grammar().clauses("idiotic village") == ([], 2)  # a seed word is a whole word


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "?!", "123", "é" * 20])
def test_texts_without_a_match_score_alike(text):
    assert Grammar().features(text) == (0.0, 0.0, 0.0, 0)


def test_learned_prefixes_and_transfer_to_workers():
    import pickle

    grammar = Grammar({"bloz^": 4.0, "=tak": 3.0}, (-2.0, 2.0, 0.1, 0.1))
    again = pickle.loads(pickle.dumps(grammar))
    assert again.features("er bloziert tak takt") == grammar.features("er bloziert tak takt")
    assert grammar.symbol("blozende") == ("I", 4.0) and grammar.symbol("takt") == (".", 0.0)


def test_very_long_text():
    found, words = Grammar().clauses("word " * 200_000 + "idiot")
    assert len(found) == 1 and words == 200_001


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_scores_of_odd_tables(spark):
    rows = [(1, "you idiot, you moron", 9.0), (1, "you idiot, you moron", 9.0), (None, None, 1.0), (2, "", 1.0), (3, "fine", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = rows_of(toxicity.score(docs, Grammar()).select("doc_id", "held_out", "score", "predicted"))
    assert len(got) == 5 and all(0 <= g[2] <= 1 for g in got)
    assert {g[0]: g[3] for g in got} == {1: 1, None: 0, 2: 0, 3: 0}
    assert {g[0]: g[1] for g in got if g[0]} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 3)}
    kept = toxicity.apply(docs, Grammar())
    assert kept.columns == docs.columns and sorted(r[0] or 0 for r in rows_of(kept)) == [0, 2, 3]
    assert toxicity.score(docs.limit(0), Grammar()).count() == 0


def test_fit_without_both_classes_is_the_seed_grammar(spark):
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(20)], "doc_id long, text string")
    for rows in ([], [(i, 0) for i in range(20)], [(None, 1), (3, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert toxicity.fit(docs, labels) == Grammar()


def test_labels_of_the_held_out_quarter_are_never_read(spark, sentence):
    ids = list(range(400))
    docs = spark.createDataFrame([(i, sentence(i, 30) + (" zorvax" if i % 5 == 0 else "")) for i in ids], "doc_id long, text string")
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(i, int(i % 5 == 0)) for i in ids]
    wrong = [(i, 1 - y if i in held else y) for i, y in right]
    fits = [toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (right, wrong)]
    assert fits[0] == fits[1] and "=zorvax" in fits[0].weights
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, fits[0]).collect()}
    assert all(got[i] == int(i % 5 == 0) for i in ids)


def test_held_out_accuracy_on_the_given_tables(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.score(docs, toxicity.fit(docs, labels)).filter("held_out").join(labels, "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert n.get((0, 1), 0) <= 0.05 * n[0, 0]
    # a third of the toxic documents use words of other languages, too few here to be learned
    assert n.get((1, 1), 0) >= 0.5 * (n.get((1, 1), 0) + n.get((1, 0), 0))


def test_several_texts_under_one_id(spark, frame):
    docs = frame([(1, t) for t in ("b text", "a text", None, "c text")] + [(3, "fine")])
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    picked = {tuple(sorted((r["doc_id"], r["text"], r["toxic"]) for r in toxicity._sample(
        docs.repartition(n), labels, 10, 10).collect())) for n in (1, 3, 7)}
    assert len(picked) == 1
