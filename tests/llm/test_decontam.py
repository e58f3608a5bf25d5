from corpus import LINE, contamination, corpus, frame

from paperfield.llm import decontam


def check(spark, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id", "1 as words")
    found = decontam.contamination(frame(spark, rows), table)
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in found.collect()} == contamination(rows, items)


def test_same_as_every_window(spark):
    rows = corpus()
    texts = [t for _, t in rows if t and len(t.split()) > 20]
    items = [(i, " ".join(t.split()[5:35])) for i, t in enumerate(texts[:6])]
    items += [(20, LINE.upper()), (21, LINE), (22, "short one"), (23, "ÉA"), (24, ""), (25, None), (26, "z" * 3000), (27, "ab"), (None, texts[7]), (28, " ".join(texts[8].split()[:13]))]
    rows += [(9000, "a SHORT: one, and short\none"), (9001, "Éa éa ÉA"), (9002, "ΟΔΟΣ ΟΔΟς"), (9003, "ab " * 50)]
    check(spark, rows, items)
    check(spark, rows, [*items, (30, "ΟΔΟΣ ΟΔΟς")])


def test_without_items_or_documents(spark):
    check(spark, corpus(8), [])
    check(spark, corpus(8), [(1, "...")])
    check(spark, [], [(1, LINE)])


def test_null_and_repeated_ids(spark):
    rows = [(None, LINE), (1, LINE), (1, LINE), (1, "no words of it")]
    items = spark.createDataFrame([(7, LINE)], "item_id long, text string")
    got = sorted(((r.doc_id, r.n_hit > 0) for r in decontam.contamination(frame(spark, rows), items).collect()), key=repr)
    assert got == [(1, False), (1, True), (1, True), (None, True)]


def test_rule(spark):
    cases = [(0, 0, False), (10, 0, False), (20, 1, True), (21, 1, False), (40, 2, True)]
    df = spark.createDataFrame([(i, n, h) for i, (n, h, _) in enumerate(cases)], "i int, n_words long, n_hit long")
    got = {r.i: r.c for r in df.select("i", decontam.is_contaminated().alias("c")).collect()}
    assert got == {i: c for i, (*_, c) in enumerate(cases)}
