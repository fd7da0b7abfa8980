"""Plain identifiers against the plain patterns, and disguised ones with their source spans."""

import random
import re
import time

import pytest

from shelfmark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def brute(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(text)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@pytest.mark.parametrize("letters", ["ab@.-_ 1", "0123456789 -.+()", "a@b.c_d1.2 "])
def test_plain_spans(letters):
    draw = random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 60)))
        assert pii.find_plain(text) == brute(text)


@pytest.mark.parametrize("text, kind, found", [
    ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("to john dot doe at example dot org", "email", "john dot doe at example dot org"),
    ("call plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven"),
    ("host 192 dot 168 dot 1 dot 20 up", "ip", "192 dot 168 dot 1 dot 20"),
    ("one nine two dot one six eight dot one dot two", "ip",
     "one nine two dot one six eight dot one dot two"),
    ("see jоhn@mail.com x", "email", "jоhn@mail.com"),
    ("ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ", "email",
     "ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ"),
    ("a​b@c​.de", "email", "a​b@c​.de"),
    ("j.d2 at mail.example.com ok", "email", "j.d2 at mail.example.com"),
    ("x john AT example DOT com y", "email", "john AT example DOT com"),
    ("x john @ example.com y", "email", "john @ example.com"),
    ("x john @ example . com y", "email", "john @ example . com"),
    ("x john-at-example-dot-com y", "email", "john-at-example-dot-com"),
    ("x john&#64;example&#46;com y", "email", "john&#64;example&#46;com"),
    ("10(dot)0(dot)0(dot)7", "ip", "10(dot)0(dot)0(dot)7"),
    ("four one five zero 9406 1614 3001", "card", "four one five zero 9406 1614 3001"),
])
def test_disguises_map_back(text, kind, found):
    _, added = pii.find(text)
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in added] == [(kind, found)]


@pytest.mark.parametrize("text", [
    "look at the dot there", "met at noon. there", "one two three", "un deux trois", "(at) home",
    "he is at 5.5 points", "look-at-me. Then", "5 @ 3 each. So", "the point is at hand"])
def test_ordinary_texts_stay(text):
    assert pii.find(text) == ([], [])


def test_masks():
    text = "x a@b.cc and a [at] b.cc end"
    plain, added = pii.find(text)
    assert pii.masked(text, [*plain, *added]) == "x <EMAIL> and <EMAIL> end"


@pytest.mark.parametrize("text", ["a" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000,
                                  " at " * 70_000, "x dot " * 50_000, "[ " * 100_000])
def test_time_is_in_proportion_to_the_text(text):
    start = time.process_time()
    pii.find(text)
    assert time.process_time() - start < 10


@pytest.mark.parametrize("text, kind", [
    ("jane_doe_at_mail.example.com", "email"), ("j.d2-at-mail.example.com", "email"),
    ("jane at mail . com", "email"), ("10 . 0 . 0 . 7", "ip"),
    ("+1 five 5 five 0 one 2 three 4", "phone"), ("one.two.three.four", "ip"),
    ("john dot doe at example dot museum", "email"), ("jane at mail dot example dot travel", "email"),
    ("jane @ example dot photography", "email")])
def test_disguises_pass_the_quick_look(text, kind):
    for around in ("%s", "so %s, and"):
        plain, added = pii.find(around % text)
        assert kind in {pii.KINDS[k] for k, _, _ in [*plain, *added]}


def test_quick_look_changes_nothing():
    draw = random.Random(4)
    parts = ["at", "dot", "point", " ", " ", " ", ".", "@", "-", "_", "*", "[", "]", "one", "five",
             "5", "10", "jane", "mail", "com", "plus", "&#46;", "&commat;", "arroba", "museum", "+"]
    for _ in range(6000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(3, 24)))
        some, every = pii.rewrite(text), pii.rewrite(text, quick=False)
        assert (some and some.text) == (every and every.text), text
