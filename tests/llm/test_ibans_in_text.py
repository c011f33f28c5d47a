"""IBANs end where their country's length ends, whatever follows."""

from __future__ import annotations

import pytest

from pcmarts.llm import pii

VALID = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606", "GB29NWBK60161331926819"]


def checked(country: str, body: str) -> str:
    digits = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{country}{98 - int(digits) % 97:02d}{body}"


def test_ibans_and_what_follows(spark):
    after = ["", " BIC: X", " EUR", " 2024", " 2 payments", " EUR 20", ".", " A", " DE12", "\nNEXT"]
    texts, want = [], []
    for iban in VALID:
        for tail in after:
            for head in ("", "é pay ", "REF 12 "):
                texts.append(head + iban + tail)
                want.append([(len(head), len(head) + len(iban))])
    pairs = [(a, b) for a in VALID for b in VALID]
    texts += [f"{a} {b}" for a, b in pairs]
    want += [[(0, len(a)), (len(a) + 1, len(a) + 1 + len(b))] for a, b in pairs]
    # A start that is no IBAN, of a known country and of another one, hides none; a country without a length is found as before.
    other = checked("ZZ", "12345678901234")
    texts += ["ES12 " + VALID[3], "ZZ12 3456 7890 " + VALID[1], f"to {other} now", "DE88 3704 0044 0532 0130 00", "x" + VALID[6], "DE89 3704", None, "AB12 " * 3000 + VALID[0]]
    want += [[(5, 32)], [(15, 34)], [(3, 3 + len(other))], [], [], [], [], [(15000, 15000 + len(VALID[0]))]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.with_spans(docs).collect()}
    assert [(texts[k], got[k], w) for k, w in enumerate(want) if got[k] != w] == []
    hidden = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert hidden[1] == "é pay [IBAN]" and hidden[0] == "[IBAN]" and hidden[3] == "[IBAN] BIC: X" and hidden[len(VALID) * 30 + 1] == "[IBAN] [IBAN]"


@pytest.mark.parametrize("tail", ["", " account"])
def test_score_of_words_nearby(spark, tail):
    docs = spark.createDataFrame([(1, VALID[0] + tail)], "doc_id int, text string")
    (span,) = pii.with_spans(docs).first().spans
    assert span.score == pytest.approx(0.9 if tail else 0.6)
