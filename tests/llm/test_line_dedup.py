"""Line runs against a plain version."""

import random

import pytest

from reelrank.llm import line_dedup


def brute(rows, min_lines, min_words):
    """rows: distinct (doc_id, text), doc_ids distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        keys = [lines[i].strip(" \t\r\x0b\x0c") for i in at]
        gone = set()
        for s in range(len(keys)):
            if (keys[s],) in seen and len(keys[s].split()) >= min_words:
                gone.add(s)
            seen.add((keys[s],))
            run = tuple(keys[s:s + min_lines])
            if len(run) == min_lines:
                if ("run", run) in seen:
                    gone |= set(range(s, s + min_lines))
                seen.add(("run", run))
        drop = {at[s] for s in gone}
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in drop)
        runs = sum(s - 1 not in gone for s in gone)
        out[doc_id] = (len(keys), len(gone), runs, kept)
    return out


@pytest.mark.parametrize("min_lines,min_words", [(2, 10), (1, 1), (3, 1000), (5, 2), (4, 10)])
def test_equals_brute_force(frame, sentence, min_lines, min_words):
    rng = random.Random(min_lines)
    pool = [sentence(i, rng.randint(1, 14)) for i in range(12)]
    rows = []
    for i in range(50):
        lines = [rng.choice(pool) if rng.random() < 0.7 else sentence(1000 + 40 * i + k, 6) for k in range(rng.randrange(12))]
        lines = [rng.choice(["", " ", "\t"]) + x + rng.choice(["", "\r"]) if rng.random() < 0.2 else x for x in lines]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), " ")
        rows.append((i * 7 % 50, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "x\n" * 40), (None, rows[0][1])]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_runs"], r["kept_text"])
           for r in line_dedup.dedup_lines(frame(rows), min_lines, min_words).collect()}
    assert got == brute(rows, min_lines, min_words)


def test_apply_keeps_columns_drops_copies_and_counts_anew(spark, sentence):
    a, b = sentence(1, 12), sentence(2, 12)
    rows = [(1, f"{a}\n{b}", 99, 0), (2, f"{a}\n{b}", 99, 1), (3, f"new\n{a}", 99, 2), (4, None, 7, 3), (5, "", 0, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _gone int")
    got = line_dedup.apply(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], (3, "new", 3, 2), rows[3], rows[4]]


def test_repeated_rows_get_the_same_result(frame, sentence):
    text = sentence(1, 12)
    got = line_dedup.dedup_lines(frame([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 1)]


def test_empty_table(frame):
    assert line_dedup.dedup_lines(frame([])).count() == 0
    assert line_dedup.apply(frame([])).count() == 0


