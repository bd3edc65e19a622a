import re

from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from sigloom.functions import lexicon, markup, paths, text


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(make(F.col("v")).alias("r")).first()["r"]


def test_stop_words_are_those_of_spark(spark):
    assert lexicon.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_modes(spark):
    assert one(spark, "Año 12: x-ray\n[a]", lambda c: text.clean(c)) == "A o   : x ray\n a "
    assert one(spark, "a:b", lambda c: text.clean(c, "letters_nocolon")) == "ab"
    assert one(spark, "été of $5, word. ab1 x_y", lambda c: text.clean(c, "strict")) == "été     word  ab x y"
    assert one(spark, "a [b %]% c", lambda c: text.clean(c, "brackets")) == "a  b   c"
    assert one(spark, "one\ttwo; three  four.", lambda c: text.clean(c, "ner")) == "one two three four "


def test_tokenizers_match_spark(spark):
    values = ["a  B c ", "", "   ", " lead", "x\ty\n", "One two  three", "\n"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    ours = df.select("v", text.tokenize("v", "simple").alias("s"), text.tokenize("v", "regex").alias("r"))
    ours = Tokenizer(inputCol="v", outputCol="ts").transform(ours)
    ours = RegexTokenizer(inputCol="v", outputCol="tr", pattern=r"\s+", minTokenLength=1).transform(ours)
    for r in ours.collect():
        assert r.s == r.ts, r
        assert r.r == r.tr, r


def test_words_equal_clean_then_tokenize(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    same = df.select((text.words("text") == text.tokenize(text.clean("text"), "regex")).alias("s"))
    assert same.filter(~F.col("s")).count() == 0
    slow = F.regexp_replace("text", r"[^a-zA-Z\s:]", " ")
    assert df.filter(text.clean("text") != slow).count() == 0


def test_stop_words_and_ngrams_match_spark(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select(text.tokenize("text", "regex").alias("t"))
    df = StopWordsRemover(inputCol="t", outputCol="k").transform(df)
    df = NGram(n=3, inputCol="t", outputCol="g").transform(df)
    bad = df.filter((F.col("k") != text.remove_stop_words("t")) | (F.col("g") != text.ngrams("t", 3)))
    assert bad.count() == 0


def test_short_ngrams(spark):
    assert one(spark, ["a"], lambda c: text.ngrams(c, 2), "array<string>") == []
    assert one(spark, [], lambda c: text.ngrams(c, 2), "array<string>") == []


def test_plural_rule(spark):
    words = ["ponies", "toes", "cats", "class", "virus", "pies", "houses", "dies", "a", "trees", "shoes"]
    got = [one(spark, w, text.strip_plural) for w in words]
    assert got == ["pony", "toe", "cat", "class", "virus", "py", "house", "dy", "a", "tree", "shoe"]
    assert one(spark, ["was", "cats"], lambda c: text.lemma_array(c, lexicon.IRREGULAR_LEMMAS), "array<string>") == ["be", "cat"]


def test_paths(spark):
    assert one(spark, "/x/cricket/001.txt", paths.topic_of_path) == "cricket"
    assert one(spark, "/x/cricket/001.txt", paths.doc_key) == "cricket/001.txt"
    assert one(spark, "alone", paths.topic_of_path) is None


def test_entities(spark):
    decode = markup.decode_entities
    assert one(spark, "a&amp;lt; &#169; &#xA9 &nosuch; &eacute;t&eacute; &", decode) == "a&lt; © © &nosuch; été &"
    assert one(spark, "&copy2008 &#0; &#x110000;", decode) == "&copy2008 &#0; &#x110000;"
    assert one(spark, "&#x0000000000041; &#X42; &#0000000000000000000067; &apos;", decode) == "A B C '"
    assert one(spark, "&#99999999; &#x1234567; &# &;", decode) == "&#99999999; &#x1234567; &# &;"


def test_wiki_text(spark):
    nested = "{{" * 9 + "x" + "}}" * 9
    source = (
        f"'''Bold''' {nested}and [[Cat|cats]]s [[dog]]s [[Image:x.png|a [[b]] c]]<ref>n</ref><ref name=q/>.\n"
        "* item\n== Head ==\n{| table |}text &amp; [http://x.org site] [http://x.org]"
    )
    plain = one(spark, source, markup.wiki_to_text)
    assert plain == "Bold and catss dogs .\n\nHead\n\ntext & site "
    marked = one(spark, "# one\n# two\nx\n# ''three''\n** deep <u>u</u>", lambda c: markup.wiki_to_text(c, True))
    assert marked == "1. one\n2. two\nx\n1. /three/\n-- deep _u_"


def test_html_text(spark):
    page = "<head><title>t</title></head><p>One<!-- no --> &amp; two<br>three</p><ul><li>x</li></ul><table><td>y</table><p>end"
    assert one(spark, page, markup.html_to_text).strip() == "One & two\nthree\n\nend"


def test_namespaces_and_redirects(spark):
    cases = {"Category:A": -8, "kategorie: B": -8, "de:C": -9, "simple:D": -9, "Bild:E": 6, "Template:F": 11, "Plain": 0, ":G": 0, "Other:H": 0}
    for title, want in cases.items():
        assert one(spark, title, markup.page_namespace) == want, title
    assert one(spark, "#Redirect [[foo bar]]\nrest", markup.redirect_target) == "Foo bar"
    for source in ("#REDIRECT [[a|b]]", " #redirect: [[ a ]] {{R}}", "#redirect[[A]]\n#redirect [[b]]"):
        assert one(spark, source, markup.redirect_target) == "A"
    for source in ("plain", "see #redirect [[a]]", "#REDIRECT a", None):
        assert one(spark, source, markup.redirect_target) is None


def test_titles(spark):
    line = '<td><a href="http://en.example.org/wiki/C%2B%2B_a+b_100%">'
    assert one(spark, line, markup.ranked_title) == "C++ a+b 100%"
    assert one(spark, " " + line, markup.ranked_title) is None
    assert one(spark, "AC/DC é*", markup.title_slug) == "AC%2FDC_%C3%A9%2A"


def test_links(spark):
    links = one(spark, "[[a]] [[b|c]]s [[d|e|f]]", markup.wiki_links)
    assert [(r.target, r.anchor) for r in links] == [("a", "a"), ("b", "cs"), ("d", "e")]
    assert one(spark, '<a href="/x" class="y">z</a>', markup.html_links)[0].anchor == "z"


def test_link_mark_and_stray_braces(spark):
    marked = one(spark, "see [[a]] and [[b|c]] $1", lambda c: markup.wiki_to_text(c, link_mark="$>"))
    assert marked == "see $>a and $>c $1"
    assert one(spark, "{{ " * 500 + "open }} end", markup.wiki_to_text) == "{{ " * 499 + " end"
    assert one(spark, "{{{1|x}}} a {{b|{{{2}}}}} c", markup.wiki_to_text).split() == ["a", "c"]


def test_wiki_steps_meet_only_texts_that_hold_their_marks(spark):
    # Marks are compared, not matched one by one, and a step with a mark looks for it first.
    nested = markup._inside_out(F.col("c"), "{{", "}}", [("x", "")])
    assert "RLIKE" not in spark.createDataFrame([("",)], "c string").select(nested.alias("n"))._jdf.queryExecution().toString()
    assert one(spark, "a {{b {{c|{{d}}}} e}} f {{g}}{", lambda c: markup._inside_out(c, "{{", "}}", [(r"\{\{[^{}]*\}\}", "")])) == "a  f {"
    # Pairs that only come about by the passes stay, as often as the text is nested decides.
    assert one(spark, "{{{x}}{y}}", lambda c: markup._inside_out(c, "{{", "}}", [(r"\{\{[^{}]*\}\}", "")])) == "{{y}}"
    assert one(spark, "{| {{ |} }}", lambda c: markup._inside_out(c, "{|", "|}", [(r"\{\|[^{}]*\|\}", "")])) == "{| {{ |} }}"
    for text in ["", "\n", "\n\n", "\n\n\n", "\na", "\n\na\n", " \n a \t\n\t\n\n b ", "a\n\n\n\nb\n\nc\nd", "a \n", "\n \n\n", " "]:
        lines = text.split("\n")
        last = len(lines) - 1
        trimmed = [(x if i == 0 else x.lstrip(" \t")) for i, x in enumerate(lines)]
        trimmed = [(x if i == last else x.rstrip(" \t")) for i, x in enumerate(trimmed)]
        assert one(spark, text, markup._trim_blank_lines) == re.sub(r"\n\n+|\A\n+", "\n\n", "\n".join(trimmed))
    assert one(spark, "&#x0041;&#065&amp;lt;&nosuch;&;&&lt&#xZ;&#55555555;&eacute;x", markup.decode_entities) == "AA&lt;&nosuch;&;&<&#xZ;&#55555555;éx"
