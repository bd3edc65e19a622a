from sigloom.operators import lemmas


def pairs(spark, rows):
    return spark.createDataFrame(rows, "form string, lemma string")


def test_rules_are_counted_and_the_longest_suffix_wins(spark):
    lexicon = pairs(spark, [("cities", "city"), ("ponies", "pony"), ("flies", "fly"), ("cats", "cat"), ("dogs", "dog"), ("cats", "cat"), ("mice", "mouse")])
    rules = lemmas.suffix_rules(lexicon)
    got = {r.suffix: (r.replacement, r.n) for r in rules.collect()}
    assert got == {"ies": ("y", 3), "s": ("", 2)}
    terms = spark.createDataFrame([(t,) for t in ["berries", "hats", "mice", "ies", "s", "tree", "hats", None, ""]], "term string")
    found = {r.term: r.lemma for r in lemmas.rule_lemmas(terms, lexicon, rules).collect()}
    assert found == {"berries": "berry", "hats": "hat", "mice": "mouse", "ies": "ie", "s": "s", "tree": "tree", "": ""}


def test_tokens_keep_their_order(spark):
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "term string, lemma string")
    docs = spark.createDataFrame([(1, ["dogs", "and", "cats", "dogs"], "x"), (2, [], "y"), (3, None, "z")], "doc_id long, tokens array<string>, topic string")
    got = {r.doc_id: (r.tokens, r.topic) for r in lemmas.lemma_tokens(docs, table, ["doc_id"]).collect()}
    assert got == {1: (["dog", "and", "cat", "dog"], "x"), 2: ([], "y"), 3: ([], "z")}


def test_nothing_to_learn(spark):
    none = pairs(spark, [(None, "a"), ("a", None)])
    assert lemmas.suffix_rules(none).count() == 0
    terms = spark.createDataFrame([("cats",)], "term string")
    assert [tuple(r) for r in lemmas.rule_lemmas(terms, none.limit(0), lemmas.suffix_rules(none)).collect()] == [("cats", "cats")]
