import random
import re

from gridweave.llm import crf, pii

SCHEMA = "doc_id long, text string, n_chars long, spans string, n_email int"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and crf.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_patterns():
    rng = random.Random(1)
    for alphabet in ("aZ09.@+-% ()\n1é", "0123456789 -.+", "ab@.-", "1.2 "):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70)))
            assert pii.base_spans(text) == brute(text), text
    assert [s[0] for s in pii.base_spans("4111 1111-1111 1111, 10.0.0.255 +1 (555) 010-9999 a.b@c-d.org")] == ["email", "ip", "card", "phone"]


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "x" * 400_000 + " 1@"):
        pii.find([text], crf.train())


def test_held_out_sentences():
    model, made = crf.train(), crf.sentences(300, 123)
    found = crf.decode(model, [crf.candidates(t) for t, _ in made])
    pairs = [(g, p) for (_, gold), own in zip(made, found) for g, p in zip(gold, own)]
    assert sum(g == p for g, p in pairs) >= 0.98 * len(pairs)


def test_repetition_carries_a_label_over():
    """A code that is named as a password once is one wherever it stands; the same code alone is none."""
    far = " ".join(["words"] * 300)
    named = f"password : kX7pQ9mB2a {far} kX7pQ9mB2a {far} kX7pQ9mB2a."
    alone = f"{far} kX7pQ9mB2a"
    (_, more), (_, none) = pii.find([named, alone], crf.train())
    assert [named[a:b] for k, a, b in more if k == "secret"] == ["kX7pQ9mB2a"] * 3 and none == []


def test_texts_written_by_hand():
    """Not made by the generator: what is found beyond the patterns, kind by kind."""
    told = {
        "call 555-123-4567 now": [("phone", "555-123-4567")],
        "my key=abcD1234efgh5 works": [("secret", "abcD1234efgh5")],
        "password = hunterdragon, and again hunterdragon": [("secret", "hunterdragon")] * 2,
        "pin 4821, not 2024: 4821": [("secret", "4821")] * 2,
        "Telefon 030/1234567, abends": [("phone", "030/1234567")],
        "tel 5551234 or 5551234": [("phone", "5551234")] * 2,
        "Passwort: geheim99x steht da, geheim99x": [("secret", "geheim99x")] * 2,
        "contraseña: tormenta1 y tormenta1": [("secret", "tormenta1")] * 2,
        "mail admin@localhost and admin@localhost": [("email", "admin@localhost")] * 2,
        "the key: patience. The secret: nothing": [],
        "isbn 978-3-16-148410-0, pages 12-34, 3.5 stars": [],
        "see https://example.com:8080/a?key=1 or part 12B": [],
        "commit 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b of 2023-11-05": [],
    }
    for text, want in told.items():
        ((base, more),) = pii.find([text], crf.train())
        assert [(k, text[a:b]) for k, a, b in more] == want and base == [], text


def test_codes_that_are_mentioned_often_are_no_secrets():
    far = " ".join(["words"] * 9)
    for code in ("RTX4090Super", "GPT4Turbo128k", "BX200-77A9", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "Win11Pro23H2", "SKU4471XZ"):
        for times in (1, 2, 3, 5, 10, 50):
            text = " ".join(f"{far} {code}," for _ in range(times))
            assert pii.find([text], crf.train()) == [([], [])], (code, times)
    for times in (1, 30, 200):
        text = "password : kX7pQ9mB2a " + " ".join(f"{far} kX7pQ9mB2a" for _ in range(times))
        assert len(pii.find([text], crf.train())[0][1]) == times + 1


def test_numbers_of_many_digits():
    text = "1.2.3." + "0" * 5000 + "1 and " + "²" * 16 + " 4" + "0" * 5000 + ".1.1.1"
    assert pii.base_spans(text) == [("ip", 0, 5007)]
    pii.find([text, "9" * 200_000 + "x", "a@" + ".b" * 50_000 + "@", "=1" * 50_000, "key=" * 50_000], crf.train())


def test_graphs_of_bounded_size_give_the_same():
    tokens = [crf.candidates(text) for text, _ in crf.sentences(60, 5)]
    assert crf.decode(crf.train(), tokens, most=30) == crf.decode(crf.train(), tokens)


def test_clean_texts_are_left_alone():
    clean = ["In 2024, on 2024-03-01 at 12:30, 7 of 9 saw 3.5 or 1,200 things.", "version 1.2.3 of part4 costs 19.99", "", None, "no numbers at all", "9807915762804490 is no card"]
    assert all(base == [] and more == [] for base, more in pii.find(clean, crf.train()))


def test_rows_and_redaction(spark):
    token = "0" + "a1" * 16
    text = f'é mail a.b@c.org, ip 1.2.3.4; token = "{token}" end'
    rows = [(1, text, 5, "c", 1), (1, text, 5, "c", 1), (2, None, None, "c", 1), (None, "", 0, "c", 1), (3, "clean", 9, "c", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["doc_id"], r["n_email"], r["n_ip"], r["n_secret"], r["spans"]) for r in pii.personal_data(df).collect()}
    at = text.index(token)
    assert (1, 1, 1, 1, f"email:7:16,ip:21:28,secret:{at}:{at + len(token)}") in got and (2, 0, 0, 0, "") in got and (None, 0, 0, 0, "") in got
    out = pii.redact(df)
    assert out.columns == df.columns
    cleaned = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    want = 'é mail [EMAIL], ip [IP]; token = "[SECRET]" end'
    assert cleaned == {(1, want, len(want)), (2, None, None), (None, "", 0), (3, "clean", 5)}
    assert pii.personal_data(df.limit(0)).count() == 0
