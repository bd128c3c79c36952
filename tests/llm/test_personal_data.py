"""Personal data against the plain patterns, odd characters in every disguise, and the columns of redacted documents."""

import re

import numpy as np
import pytest

from stallwatch.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


def card(rng):
    head = "".join(map(str, rng.integers(0, 10, int(rng.integers(15, 19)))))
    number = next(head + str(d) for d in range(10) if luhn(head + str(d)))
    return "".join(c + str(rng.choice(["", "", "", " ", "-"])) for c in number[:-1]) + number[-1]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(21)
    seen = dict.fromkeys(pii.KINDS, 0)
    cards = [card(rng) for _ in range(200)]
    pieces = ["a@b.c", "1.2.3.4", "255.0.0.256", "+49 (0)30 1234567", "+1", " ", "-", ".", "@", "x", "ſ", "é", "0", "12", "\n"]
    for i in range(6000):
        parts = [*pieces, cards[i % 200], cards[i % 199][:-1] + "3"]
        text = ["", " ", "a"][i % 3].join(parts[j] for j in rng.integers(0, len(parts), int(rng.integers(1, 12))))
        base, every = pii.find(text)
        assert base == plain(text), text
        assert all(s in every[k] for k in base for s in base[k])
        for kind in base:
            seen[kind] += len(base[kind])
    assert min(seen.values()) > 100


def test_every_character_in_every_disguise_word():
    words = [*pii._DIGIT_WORDS, "at", "dot", "punkt", "punto", "point", "arroba", "arobase", "klammeraffe", "plus"]
    odd = {"ſ", "ı", "İ", "K", "ẞ", "ß", "ﬁ", "ﬅ", "é", "é", "​", "ａ", "ﾡ", "\U0001d7d9"}
    every = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(every), 4096):  # each character in place of a letter of each word, one word after the other
        block = every[start : start + 4096]
        pii.find(" ".join(w[: i % len(w)] + c + w[i % len(w) + 1 :] for i, (c, w) in enumerate((c, words[(start + i) % len(words)]) for i, c in enumerate(block))))
    for c in odd:
        for w in words:
            for i in range(len(w)):
                word = w[:i] + c + w[i + 1 :]
                for text in (f"{word} four", f"four {word} {word}", f"1.{word}.3 dot 4", f"a.b {word} c.com", f"a [{word}] b [dot] com"):
                    base, spans = pii.find(text)
                    assert all(0 <= s < e <= len(text) for k in spans for s, e in spans[k])


def test_random_texts_of_disguises():
    rng = np.random.default_rng(22)
    pieces = ["ſix", "SİX", "four", "Klammeraffe", "at", "dot", "[", "]", "(", ")", " ", " ", "@", ".", "com", "example", "jo", "1", "0", "O", "l", "plus", "+", "​", "ａ", "а", "\n", "--", "eins", "oh", "un"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces, int(rng.integers(1, 14))))
        base, spans = pii.find(text)
        for kind in pii.KINDS:
            assert spans[kind] == sorted(set(spans[kind])) and set(base[kind]) <= set(spans[kind])
            assert all(0 <= s < e <= len(text) for s, e in spans[kind])
        clean = pii.redact(text, spans)
        assert (clean == text) == (not any(spans.values()))


@pytest.mark.parametrize("text, kind, found", [
    ("write jane.doe at example.com now", "email", "jane.doe at example.com"), ("jane dot doe at example.com", "email", "jane dot doe at example.com"), ("ring plus un uno zwo eins un un eins un un now", "phone", "plus un uno zwo eins un un eins un un"),
    ("ip one dot ſix dot two dot three", "ip", "one dot ſix dot two dot three"), ("jo@example dot com", "email", "jo@example dot com"), ("plus ſix four ſix four ſix four ſix four", "phone", "plus ſix four ſix four ſix four ſix four"),
])
def test_more_disguises(text, kind, found):
    base, every = pii.find(text)
    assert [text[a:b] for a, b in every[kind]] == [found]


@pytest.mark.parametrize("text", ["visit us at example.com", "jane at example.com", "ſix four", "version 2.0 at noon", "one or two", "un uno"])
def test_nothing_found(text):
    base, every = pii.find(text)
    assert not any(every.values())


def test_long_runs_are_read_once():
    for text in (" " * 3_000_000 + "dot (", "(" * 1_000_000, "a@" * 500_000, "+1(" * 400_000, "one " * 300_000, "a.b at " * 200_000, "0 " * 400_000, "a@b.cс " * 100_000):
        pii.find(text)


def test_redacted_documents_keep_their_columns(spark):
    rows = [(1, "mail jo@ex.org, ſix four", 5, 9, "x"), (2, None, 0, 9, "y"), (3, "", 0, 9, None), (3, "", 0, 9, None), (None, "ip 1.2.3.4", 3, 9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, n_email int, redacted_text string")
    out = pii.redact_personal_data(docs)
    assert out.schema == docs.schema
    assert sorted(out.collect(), key=str) == sorted(spark.createDataFrame([(1, "mail <EMAIL>, ſix four", 22, 9, "x"), (2, None, None, 9, "y"), (3, "", 0, 9, None), (3, "", 0, 9, None), (None, "ip <IP>", 7, 9, "z")], docs.schema).collect(), key=str)
    body = docs.withColumnRenamed("text", "body").withColumn("text", docs.doc_id.cast("string"))  # another column has the usual name
    assert sorted(r.body or "" for r in pii.redact_personal_data(body, "body").collect()) == sorted(r.text or "" for r in out.collect())
    found = pii.find_personal_data(body, "body", keep=["doc_id", "text"])
    assert {(r.doc_id, r.text, r.n_email) for r in found.collect()} == {(1, "1", 1), (2, "2", 0), (3, "3", 0), (None, None, 0)}
