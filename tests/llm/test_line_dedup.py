"""Line dedup against a plain loop over all windows."""

import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup

BLANKS = " \t\x0b\x0c\r"


def brute_force(rows):
    """``doc_id -> (n_removed, text)``; earlier is a smaller document, or further up."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = (text or "").split("\n")
        marked = [(i, line.strip(BLANKS)) for i, line in enumerate(lines) if line.strip(BLANKS)]
        gone = set()
        for k in range(len(marked) - 2):
            window = tuple(line for _, line in marked[k : k + 3])
            if window in seen:
                gone |= set(range(marked[k][0], marked[k + 2][0] + 1))
            seen.add(window)
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out[doc] = (len(gone), None if text is None else kept)
    return out


def collected(docs):
    return {r.doc_id: (r.n_removed, r.text) for r in line_dedup.without_repeats(docs).collect()}


def test_random_documents(spark, frame):
    draws = random.Random(6)
    lines = ["a", "b", " c ", "", "d d", "\t", "e\r"]
    rows = [(i, "\n".join(draws.choice(lines) for _ in range(draws.randint(0, 14)))) for i in range(120)]
    assert collected(frame(rows)) == brute_force(rows)


def test_a_window_in_a_third_of_all_documents(spark, frame):
    hot = "first\n\nsecond line\nthird"
    rows = [(i, f"{i}\n{hot}\n{i}" if i % 3 == 0 else f"own {i}\nmore {i}\nlast {i}") for i in range(600)]
    assert collected(frame(rows)) == brute_force(rows)


def test_nulls_empty_and_very_long_texts(spark, frame):
    long_ = "\n".join(f"line {i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "one\ntwo"), (5, long_), (6, long_ + "\nend"), (7, "x\n" * 50)]
    assert collected(frame(rows)) == brute_force(rows)
    assert line_dedup.without_repeats(frame([])).count() == 0


def test_other_columns_stay_and_the_added_ones_replace_theirs(spark, frame):
    df = frame([(1, "a\nb\nc"), (2, "a\nb\nc")]).withColumns({c: F.lit("mine") for c in ("n_lines", "n_removed", "kept", "first", "h1", "origin")})
    got = {r.doc_id: r for r in line_dedup.without_repeats(df).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].text, got[2].first, got[2].h1) == (0, 3, "", "mine", "mine")
