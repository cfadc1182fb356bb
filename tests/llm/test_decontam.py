import pytest

from riskloom.llm import decontam
from riskloom.llm.decontam import words


def closest(pattern, text):
    """Least edits that turn pattern into a stretch of text (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    best = min(row)
    return best, row.index(best)


def test_myers(rng):
    for _ in range(300):
        pattern = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 90))]
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 120))]
        best, end = closest(pattern, text)
        got = decontam.myers(pattern, text, len(pattern) - 1)
        assert got == ((best, end) if best < len(pattern) else None)


def test_pieces():
    for n in range(1, 60):
        for e in range(0, n):
            p = decontam.pieces(n, e)
            assert len(p) == e + 1 and p[0][0] == 0 and p[-1][1] == n
            assert all(a < b for a, b in p) and all(x[1] == y[0] for x, y in zip(p, p[1:]))


def edited(rng, item, edits):
    w = item.split()
    for _ in range(edits):
        i = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[i] = "changed"
        elif kind == 1:
            w.insert(i, "added")
        elif len(w) > 1:
            del w[i]
    return " ".join(w).upper().replace(" ", " ,\n")


def want(rows, items):
    out = []
    for d, t, _ in rows:
        text = words(t)
        for i, item in items:
            p = words(item)
            if len(p) >= decontam.MIN_WORDS:
                best, _ = closest(p, text)
                if best <= int(decontam.RATE * len(p)):
                    out.append((d, i, best, len(p)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_items", [20_000, 3])
def test_all_leaks_found(spark, make_docs, rng, block_items):
    from tests.llm.conftest import prose

    items = [(i, prose(rng, rng.randint(5, 60))) for i in range(8)] + [(8, None), (9, ""), (10, "too short"), (11, "x " * 200)]
    items += [items[0]]
    rows = []
    for i in range(80):
        _, item = items[rng.randrange(8)]
        budget = int(decontam.RATE * len(item.split()))
        rows.append((i, prose(rng, rng.randint(0, 50)) + " " + edited(rng, item, rng.randint(0, budget + 2)) + " "
                     + prose(rng, rng.randint(0, 50)), "s"))
    rows += [(100, None, "s"), (101, "", "s"), (None, items[1][1], "s"), (102, items[1][1] * 1, "s"), (102, items[1][1], "s"),
             (103, "x " * 5000, "s")]
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, doc_id string")
    docs = make_docs(rows, extra=True)
    got = decontam.leaks(docs, bench, block_items=block_items)
    assert sorted(((r.doc_id, r.item_id, r.distance, r.item_words) for r in got.collect()), key=str) == want(rows, items)
    left = decontam.clean(docs, bench, block_items=block_items)
    assert left.columns == docs.columns
    dirty = {d for d, *_ in want(rows, items)}
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(d) for d, _, _ in rows if d not in dirty)


def test_case_of_all_letters(spark, make_docs):
    item = "Élan été ça où naïve Übung größer mañana señor ÉPÉE"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs([(1, "x " + item.upper().replace("SS", "ß") + " y", "s"), (2, item.lower(), "s"), (3, "x y", "s")])
    assert sorted((r.doc_id, r.distance) for r in decontam.leaks(docs, bench).collect()) == [(1, 0), (2, 0)]


def test_empty_tables(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, odd_rows[0][1])], "item_id long, text string")
    assert decontam.leaks(make_docs(odd_rows), none).collect() == []
    assert decontam.clean(make_docs(odd_rows), none).count() == len(odd_rows)
    assert decontam.leaks(make_docs([]), some).collect() == []
    assert sorted(map(str, (r.doc_id for r in decontam.leaks(make_docs(odd_rows), some).collect() if r.distance == 0)))[:2] == ["1", "2"]


def test_scripts_without_blanks(spark, make_docs):
    items = [(1, "水の沸点は何度ですか。摂氏百度です。"), (2, "เมืองหลวงของประเทศไทยคือกรุงเทพ"), (3, "光合作用发生在哪里？叶绿体"), (4, "何時")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    near = items[2][1].replace("哪里？", "何处， ")  # two characters of twelve
    rows = [(1, "前書き" + items[0][1] + "後書き", "s"), (2, "x" + items[1][1] + "\u200b" + "จบ", "s"), (3, f"问题：{near}。", "s"),
            (4, "今何時ですか", "s"), (5, "何の時", "s"), (6, items[0][1][:7], "s")]
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontam.leaks(make_docs(rows), bench).collect())
    assert got == [(1, 1, 0), (2, 2, 0), (3, 3, 2), (4, 4, 0)]
    assert [r.doc_id for r in decontam.clean(make_docs(rows), bench).orderBy("doc_id").collect()] == [5, 6]


@pytest.mark.parametrize("rate", [0.2, 0.5])
def test_short_items_match_exactly(spark, make_docs, rate):
    bench = spark.createDataFrame([(1, "four words in all"), (2, "!?")], "item_id long, text string")
    docs = make_docs([(1, "so Four words, in all.", "s"), (2, "four words at all", "s"), (3, "four words in", "s"), (4, "!?", "s")])
    assert [(r.doc_id, r.item_id, r.distance) for r in decontam.leaks(docs, bench, rate=rate).collect()] == [(1, 1, 0)]
