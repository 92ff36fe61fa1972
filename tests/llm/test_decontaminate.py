import random

import pyarrow as pa

from activitymill.llm import decontaminate as d
from activitymill.llm.words import texts
from tests.llm import corpus

ITEM = "If John Smith buys 12 apples and then 12 pears at 5 km from home, how many apples does he have left?"


def kinds(text):
    t = d.template(next(texts(pa.array([text]))))
    name = {d._NUMBER: "N", d._QUANTITY: "Q", d._NAME: "P"}
    return "".join(name.get(k, "w") for k in t.tokens), t.slots


def test_placeholders():
    assert kinds("We saw Mary Ann buy 5 km of rope, 7kg, 3.50 and 12,000")[0] == "wwPwQwwQNwN"
    assert kinds("The end. The start\nThe rest")[0] == "wwwwww"
    assert kinds("a 3rd B2B x2 NASA ... !!")[0] == "wwwww"
    shape, slots = kinds("x John Smith met John Smith and Smith John had 5 km 5km 6 km 5")
    assert shape == "wPwPwPwQQQN"
    value = {k: int(s) for k, s in enumerate(slots)}
    assert value[1] == value[3] != value[5] and value[7] != value[9] and value[10] != 0 and value[0] == 0
    assert kinds("le chat ÉTÉ Élan là")[0] == "wwwPw" and kinds("x İstanbul É")[0] == "www"
    same = [next(texts(pa.array([t]))) for t in ("Épée été", "ÉPÉE ÉTÉ", "épée Été")]
    assert len({tuple(d.template(x).tokens[:1]) for x in same}) == 1
    assert kinds("")[0] == "" and kinds("... --")[0] == ""


def found(spark, values, items=(ITEM,), **options):
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in d.hits(docs, bench, **options).collect())


def test_other_names_and_numbers_are_caught_if_they_are_consistent(spark):
    body = "buys {} apples and then {} pears at {} km from home, how many apples does he have left?"
    assert found(spark, [
        f"Some text before. If Mary {body.format(7, 7, 9)} And after.",
        f"so if Mary {body.format(7, 8, 9)} yes",  # 12 would be both 7 and 8
        ITEM.upper().replace("KM", "km"), ITEM, "nothing of the kind at all in here, really", f"If Mary {body.format(12, 12, '5 miles or')}",
    ]) == [(0, 0), (2, 0), (3, 0)]


def test_half_an_item_is_enough_and_less_is_not(spark):
    words = [f"w{k}" for k in range(40)]
    item = " ".join(words)
    assert found(spark, [" ".join(words[:24]), " ".join(words[:22]), "x " + " ".join(words[16:])], [item]) == [(0, 0), (2, 0)]


def test_short_items(spark):
    items = ["one two three four five", "tiny thing here now", None, "", "one two three four five six seven"]
    assert found(spark, ["a one two three four five b", "tiny thing here now", "one two three four five six seven"], items) == [
        (0, 0), (1, 1), (2, 0), (2, 4)]
    tiny = ["Two words", "12 km", "...", "Ann Lee Gray"]
    assert found(spark, ["x two words y", "two x words", "at 12 KM", "at 13 km", "two", "met Ann Lee Gray.", "Ann Lee Brown"], tiny) == [
        (0, 0), (2, 1), (5, 3)]


def test_hits_equal_comparing_every_item_with_every_place(spark):
    """Lower-case words, numbers and names that each are one token, and one stretch of an item in each document."""
    rng = random.Random(5)
    words = ["".join(rng.choices("bdfhklnprt", k=6)) for _ in range(400)]

    def token():
        kind = rng.choice("wwwwnp")
        return words[rng.randrange(400)] if kind == "w" else str(rng.randrange(1, 9)) if kind == "n" else rng.choice(NAMES)

    def spaced(tokens):  # names that follow each other are one, so a word stands between
        out = [words[0]]
        for t in tokens:
            out += [words[1]] if t in NAMES and out[-1] in NAMES else []
            out.append(t)
        return out

    NAMES = ["Bodo", "Carla", "Dirk", "Edda"]
    items = [spaced([token() for _ in range(k % 24)]) for k in range(60)]
    docs = []
    for k in range(240):
        item = items[k % 60]
        low = rng.choice([0, 0, rng.randrange(len(item))])
        held = item[low:rng.choice([len(item), len(item), rng.randrange(low, len(item)) + 1])]
        to = dict(zip(map(str, range(1, 9)), rng.sample([str(n) for n in range(1, 30)], 8))) | dict(zip(NAMES, rng.sample(NAMES, 4)))
        change = k // 60  # as it is, other values throughout, other values now and then, as it is
        held = [to.get(t, t) if change == 1 or change == 2 and rng.random() < 0.5 else t for t in held]
        docs.append(spaced([token() for _ in range(rng.randrange(20))] + [words[2]] + held + [words[3]] + [token() for _ in range(20)]))

    def kind(t):
        return "n" if t.isdigit() else "p" if t in NAMES else t

    def held_at(doc, item, shift, n):
        """Windows of the item at an offset, if its values stand for the same values in all of them."""
        places = [p for p in range(len(item) - n + 1) if 0 <= p + shift <= len(doc) - n
                  and all(kind(item[p + i]) == kind(doc[p + shift + i]) for i in range(n))]
        stands = {(item[i], doc[i + shift]) for p in places for i in range(p, p + n) if kind(item[i]) in "np"}
        return len(places) if len({a for a, _ in stands}) == len(stands) else 0

    def holds(doc, item):
        if len(item) < 5:
            return any(doc[i:i + len(item)] == item for i in range(len(doc)))
        n = min(8, len(item))
        needed = 0.5 * (len(item) - n + 1)
        return any(held_at(doc, item, shift, n) >= needed for shift in range(-len(item), len(doc)))

    want = sorted((i, j) for i, doc in enumerate(docs) for j, item in enumerate(items) if holds(doc, item))
    assert {min(len(items[j]), 9) for _, j in want} == set(range(1, 10))
    assert 60 < len({i for i, j in want if len(items[j]) > 4}) < 200
    assert found(spark, [" ".join(d) for d in docs], [" ".join(i) for i in items]) == want


def test_odd_rows_columns_and_empty_tables(spark):
    docs = corpus.documents(spark)
    text = docs.filter("doc_id = 7").first().text
    bench = spark.createDataFrame([(1, text, 2), (1, text, 2), (None, text, 2), (3, None, 2)], "item_id long, text string, size int")
    hits = d.hits(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == {(7, 1), (7, None)} and len(hits) == 2
    clean = d.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 2  # the row is there twice
    assert d.hits(corpus.none(spark), bench).collect() == [] and d.hits(docs, bench.limit(0)).collect() == []
    assert d.keep_clean(docs, bench.limit(0)).count() == docs.count()


def test_an_added_or_dropped_word_does_not_hide_an_item(spark):
    words = [f"w{k}" for k in range(59)]
    added, dropped = [*words[:30], "added", *words[30:]], words[:29] + words[30:]
    one = "a b c d e f g h i 12 j k l m n o p q"
    values = [" ".join(added), "x " * 700 + " ".join(dropped), " ".join(words[:20] + ["far"] * 600 + words[40:]),
              f"{one} r s t u v w {one} end".replace("12", "7"), f"{one} r s t u v w more {one} end".replace("12", "8", 1)]
    items = [" ".join(words), f"{one} r s t u v w {one} end"]
    # The halves of one copy are apart by an added word; in the last text they also take the same value for two.
    assert found(spark, values, items) == [(0, 0), (1, 0), (3, 1)]
    docs = spark.createDataFrame([(0, values[0])], "doc_id long, text string")
    row = d.hits(docs, spark.createDataFrame([(0, items[0])], "item_id long, text string")).first()
    assert (row.matched, row.windows) == (45, 52)


def test_short_items_of_names_and_items_after_a_colon(spark):
    items = ["Who painted the Mona Lisa?", "What is the capital of Peru?", "New York is a city", "Who met Ann Lee Gray?"]
    assert kinds(items[0])[0] == "wwwP"
    values = ["Question: Who painted the Mona Lisa? Nobody knows", "he asked who painted THE mona lisa.", "Who painted the Big Wall?",
              "Question: What is the capital of Peru?", 'He asked: "What is the capital of Chile?"', "so What is the capital of Peru",
              "We heard that New York is a city", "New York is a city", "Who met Ann Lee Brown?", "Who met Bob. Met Ann Lee Gray",
              "What is the capital of it"]
    assert found(spark, values, items) == [(0, 0), (1, 0), (3, 1), (4, 1), (5, 1), (6, 2), (7, 2)]
    assert found(spark, ["who met Ann Lee Gray once", "who met or met ann lee gray"], items) == [(0, 3)]


def test_clean_documents_stay_where_they_are(spark):
    """As a stage, no text is dealt anew: what goes is known by then and is few."""
    docs = spark.createDataFrame([(k, f"some words of document {k} and no more than that") for k in range(50)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words of document 7 and no more than")], "item_id long, text string")
    kept = d.keep_clean(docs, items)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert kept.count() < 50
