"""Line dedup by content: rows that share an id, null ids, equal rows."""

import random
from collections import Counter

from partsieve.llm.line_dedup import line_dedup


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter((r["doc_id"], r["n_removed"], r["kept"]) for r in line_dedup(df).collect())


def lines(s):
    return "\n".join(s.split())


def test_other_texts_under_an_id_keep_their_lines(spark):
    rows = [(1, lines("a b c d")), (7, lines("a b c q")), (7, lines("z1 z2 z3 z4"))]
    assert kept(spark, rows) == Counter([(1, 0, lines("a b c d")), (7, 3, "q"), (7, 0, lines("z1 z2 z3 z4"))])
    own = lines("u1 u2 u3 u4 u5 u6 u7 u8")
    assert kept(spark, [(None, lines("a b c d e a b c")), (None, own)]) == Counter([(None, 3, lines("a b c d e")), (None, 0, own)])


def test_equal_rows_are_copies(spark):
    assert kept(spark, [(3, lines("p q r"))] * 3) == Counter({(3, 0, lines("p q r")): 1, (3, 3, ""): 2})
    assert kept(spark, [(None, lines("p q r s"))] * 2 + [(1, lines("x p q r"))]) == Counter([(None, 0, lines("p q r s")), (None, 4, ""), (1, 3, "x")])
    assert kept(spark, [(3, "p"), (3, "p"), (4, None), (4, "")]) == Counter({(3, 0, "p"): 2, (4, 0, ""): 2})


def test_against_a_scan(spark):
    """Unique ids: every window after its first occurrence goes."""
    r = random.Random(2)
    rows = [(i, "\n".join(r.choices(["a", "b", "c", " ", ""], k=r.randrange(12)))) for i in range(60)]
    seen, want = set(), Counter()
    for i, text in rows:
        own, gone = text.split("\n"), set()
        for k in range(len(own) - 2):
            window = tuple(own[k : k + 3])
            if "".join(window).strip(" "):
                gone |= {k, k + 1, k + 2} if window in seen else set()
                seen.add(window)
        want[i, len(gone), "\n".join(x for k, x in enumerate(own) if k not in gone)] += 1
    assert kept(spark, rows) == want
