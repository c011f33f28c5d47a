"""BPE, PII, quality rules and HTML labelling against plain Python."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pcmarts.llm import bpe, htmltext, pii, rules

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
LIBRARY.no_truncation()
LIBRARY.no_padding()
OWN = bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())


def library_ids(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdefthe'srlv  \n\t0É9ßΣİ漢字½!#=<|endoftext|>\x85\x1c​ é́"), max_size=120))
def test_ids_and_text_are_those_of_the_library(text):
    (found,) = OWN.encode([text])
    ids = np.frombuffer(found, "<u4").tolist()
    assert ids == library_ids(text)
    assert OWN.decode(found) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("etaoinshr"), min_size=1, max_size=300), st.integers(1, 40))
def test_tree_gives_the_plain_encoding(word, piece):
    symbols = OWN.symbols(word)
    pieces = [OWN.run(symbols[i : i + piece]) for i in range(0, len(symbols), piece)]
    assert OWN.tree(pieces) == OWN.merge(symbols) == np.frombuffer(OWN.merge_all([word])[0], "<u4").tolist()


def test_encode_rows(spark, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 48)
    monkeypatch.setattr(bpe, "BIG", 100)  # longer texts take the path over several tasks
    texts = [(1, None), (2, ""), (3, "hello  World"), (3, "hello  World"), (None, "x" + "the" * 500 + " and " + "=" * 300 + "!"), (4, "é" * 200), (5, "a<|endoftext|>b " + "q" * 90)]
    docs = spark.createDataFrame([(i, t, 7, "k") for i, t in texts], "doc_id long, text string, n_tokens int, run string")
    got = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    want = sorted(((i, tuple(library_ids(t or ""))) for i, t in texts), key=repr)
    both = bpe.encode(docs, VOCABULARY, decoded="again").select("ids", "again").collect()
    assert all(r.again == LIBRARY.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) for r in both)
    assert sorted(((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got), key=repr) == want
    assert all(r.decoded == LIBRARY.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) and r.n_tokens * 4 == len(r.ids) and r.run == "k" for r in got)
    assert bpe.encode(docs.limit(0), VOCABULARY).count() == 0


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_base(text: str | None) -> str:
    def good(kind: str, found: str) -> bool:
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    found = [(m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if good(k, m[0])]
    return ",".join(x[2] for x in sorted(found))


def test_spans_are_those_of_plain_patterns(spark):
    rng = random.Random(3)
    texts = [None, "", "a@b.c_x@d.e x.@@y@z.q-.1 1.2.3.4.5.6.7.8 300.1.1.1 007.08.9.000", "0.0.0.0" * 700, "é4111-1111-1111-1111 é a@b.co +1 (212) 555-0199", "1" * 3000, "+1 ((((", "4111 1111 1111 1111" * 40]
    texts += ["".join(rng.choice(["@", ".", "a", "1", "4111111111111111", " ", "+1", "-", "(", ")", "é", "255", "b.c", "\n"]) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, kind string")
    got = pii.with_spans(docs).select("text", "kind", pii.listed(F.filter("spans", lambda s: s["kind_no"] < 4)).alias("base")).collect()
    assert len(got) == len(texts)
    assert [(r.text, r.base) for r in got if r.base != plain_base(r.text)] == []
    assert pii.with_spans(docs.limit(0)).count() == 0


def test_iban_score_and_redaction(spark):
    texts = ["pay to DE89 3704 0044 0532 0130 00 now", "my account DE89370400440532013000", "DE88370400440532013000", "mail me: a@b.co, a@b.co", None, "1.2.3.4"]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    spans = {r.doc_id: r.spans for r in pii.with_spans(docs).collect()}
    assert [(s.kind, s.start, s.end) for s in spans[0]] == [("iban", 7, 34)] and spans[2] == []
    assert spans[1][0].score > spans[0][0].score and spans[3][0].score == pytest.approx(0.9)
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs).collect()}
    assert got[0] == ("pay to [IBAN] now", 17) and got[3] == ("mail me: [EMAIL], [EMAIL]", 25) and got[4] == (None, None) and got[5][0] == "[IP]"


def plain_measures(text: str | None) -> tuple[int, ...]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures_are_those_of_plain_python(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\x0b ", "a b c a b c", "a a a a", "x y z # | <b>", "a b\n\na b\r\na b\n", "w " * 5000]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "c ", "$", "é "]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    docs = spark.createDataFrame([(None, t, "h") for t in texts], "doc_id long, text string, failed string")
    got = rules.ledger(docs.withColumn("kept_text", F.col("text"))).collect()
    assert [r.kept_text for r in got if (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) != plain_measures(r.kept_text)] == []
    assert len(got) == len(texts)


def test_ablations_count_what_each_rule_costs(spark):
    good = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, good), (2, "short"), (3, "a b c " * 40), (4, good.replace("w", "#")), (5, None)], "doc_id long, text string")
    ledger = rules.ledger(docs)
    counts = {(r.policy, r.version, r.left_out): (r.kept, r.kept_more) for r in rules.ablations(ledger).collect()}
    assert counts["base", 1, None] == (2, 0) and counts["base", 1, "few_words"] == (4, 2) and counts["base", 1, "repeated_words"] == (3, 1)
    kept = {r.doc_id for r in ledger.where(rules.verdict()).collect()}
    assert kept == {1} and counts["web", 2, None][0] == 1
    assert rules.ablations(ledger.limit(0)).count() == 0


HARD = (
    '<html><head><title>t</title><script>var a="</p><p>no"</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
    "<article><h1>A&amp;B</h1><p>One  two&nbsp;three<br><p>Four <b>five</b>\n six.</p><!-- x --></article><footer>&copy; me</footer>"
)


def test_leaves_of_broken_pages():
    assert [x[0] for x in htmltext.leaves(HARD)] == ["Home", "A&B", "One two three", "Four five six.", "© me"]
    for page in (None, "", "<" * 200, "<p title='open>x</p>" * 3, "<script>never closed", "<!-- open", "<div>" * 2000 + "deep"):
        assert isinstance(htmltext.leaves(page), list)


@pytest.fixture(scope="module")
def labeller(spark):
    return htmltext.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), 60)


def test_labeller_on_pages_and_layouts_it_was_not_trained_on(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = 0
    for r in pages.collect():
        inside = r.html[r.html.index("<article>") :].partition("</article>")[0]
        want = [x[0] for x in htmltext.leaves(inside)]
        found = htmltext.leaves(r.html)
        wrong += [x[0] for x, k in zip(found, labeller.main_blocks([found])[0], strict=True) if k] != want
    assert wrong <= 2
    rng = random.Random(77)
    pool = [f"w{k}" for k in range(300)]
    errors = total = 0
    for _ in range(100):
        page, labels = htmltext.layout(rng, [" ".join(rng.sample(pool, 30)) for _ in range(5)], pool)
        found = htmltext.leaves(page)
        if len(found) == len(labels):
            errors += sum(bool(a) != bool(b) for a, b in zip(labeller.main_blocks([found])[0], labels, strict=True))
            total += len(labels)
    assert total > 1000 and errors / total < 0.03


def test_extract_rows(spark, labeller):
    rows = [(1, "u", HARD, "x"), (1, "u", HARD, "x"), (None, None, None, "x"), (2, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in htmltext.extract(pages, labeller).collect())
    main = "A&B\nOne two three\nFour five six."
    assert got == [(0, "", 0), (1, main, len(main)), (1, main, len(main)), (2, "", 0)]
    assert htmltext.extract(pages.limit(0), htmltext.train(pages.limit(0))).count() == 0
