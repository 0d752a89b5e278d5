import pytest

from rainledger.llm.decontaminate import leaks, without_leaks

ASK = "A farmer named Alice carried 12 kg of barley to the old mill, where Alice sold 7 kg before noon and kept the remaining sacks for her own horses."
SWAP = ASK.replace("Alice", "Bruno").replace("12", "95").replace("7", "31")
SHOP = "In spring the trader Olga bought 14 crates and later that week Olga sold 14 crates again while the clerk Ivan counted 30 coins and the guard Ivan kept 30 coins hidden."
MOVED = SHOP.replace("Olga", "Mara").replace("Ivan", "Tomas").replace("14", "20").replace("30", "85")
BROKEN = "In spring the trader Mara bought 20 crates and later that week Ruth sold 21 crates again while the clerk Tomas counted 85 coins and the guard Mara kept 20 coins hidden."
OTHER = "Rivers in the north rise late in spring because the snow on the high plateau melts slowly and feeds many small lakes along the way."
DOCS = "doc_id long, text string, lang string, item_id int, total int"
ITEMS = "item_id long, text string, doc_id int, h int"


@pytest.fixture(scope="module")
def frames(spark):
    docs = [(1, f"Before. {ASK} After that."), (2, SWAP), (3, BROKEN), (4, OTHER), (5, None), (6, ""), (7, "word " * 100_000), (None, ASK.lower()), (8, ASK), (8, ASK), (9, " ".join(ASK.split()[:9])), (10, "12 kg " * 50), (11, MOVED)]
    items = [(100, ASK), (100, ASK), (101, "too short"), (None, OTHER), (102, None), (103, ""), (104, SHOP)]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in docs], DOCS), spark.createDataFrame([(*r, 3, 4) for r in items], ITEMS)


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_leaks(frames, most):
    docs, items = frames
    rows = {(r.doc_id, r.item_id): r for r in leaks(docs, items, most_broadcast=most).collect()}
    assert set(rows) == {(1, 100), (2, 100), (None, 100), (8, 100), (4, None), (11, 104)}
    assert rows[1, 100].exact and rows[8, 100].exact and rows[None, 100].exact and not rows[11, 104].exact
    assert rows[8, 100].coverage == 1.0 and rows[2, 100].n_slots >= 3


def test_without_leaks(frames):
    docs, items = frames
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 9, 10]


def test_empty_tables(frames):
    docs, items = frames
    assert leaks(docs.limit(0), items).collect() == [] == leaks(docs, items.limit(0)).collect()
    assert without_leaks(docs, items.limit(0)).count() == docs.count()


PENS = "A shop sells 12 pens at 3 dollars and 7 books at 9 dollars to 4 children for 5 weeks"
TALE = "Alice has many old coins in a box. Bob buys all of them for his sister. Carol finds the empty box at night."


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_dense_slots_names_at_sentence_starts_and_short_items(spark, most):
    pens = PENS.replace("12", "31").replace("3 dollars", "6 dollars").replace("7", "8").replace("9", "2").replace("4 children", "15 children").replace("5 weeks", "11 weeks")
    tale = TALE.replace("Alice", "Dora").replace("Bob", "Emil").replace("Carol", "Fritz")
    mixed = TALE.replace("Alice", "Dora").replace("Bob", "Dora").replace("Carol", "Fritz")
    docs = [(1, pens), (2, tale), (3, mixed), (4, "He asked: What is 95 plus 31? Nobody knew."), (5, "What is left of 12 plus 7"), (6, "sums: what is 12 plus 7"), (7, "44 45 46"), (8, "He said what is 5 plus 5")]
    items = [(100, PENS), (101, TALE), (102, "What is 12 plus 7?"), (103, "12 13")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in leaks(*frames, most_broadcast=most).collect()}
    assert set(rows) == {(1, 100), (2, 101), (4, 102), (6, 102)}
    assert rows[6, 102].exact and not rows[4, 102].exact and rows[1, 100].coverage == 1.0
    assert sorted(r.doc_id for r in without_leaks(*frames, most_broadcast=most).collect()) == [3, 5, 7, 8]
