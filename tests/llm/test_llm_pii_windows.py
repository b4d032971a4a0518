"""The windows that are passed over hold nothing that would be kept."""

import random
import re

import pytest
from llm_cases import prose

from claimsdq.llm.pii import WIDTH, accepted, find_spans, generated_windows, train_on, window_starts

FORMS = ["jane at example dot com", "jane.doe AT example DOT org", "jane (AT) example.org", "jane[AT]example[DOT]org",
         "jane ( at ) example ( dot ) org", "jane{at}example{dot}org", "jane_at_example_dot_org", "jane @ example.org"]


def every_start(text):
    return list(range(0, len(text), WIDTH // 2))


@pytest.fixture(scope="module")
def contexts():
    r = random.Random(2)
    return [re.sub(r"[0-9@]", "", prose(r, 30)) for _ in range(100)]


@pytest.fixture(scope="module")
def tagger(contexts):
    return train_on(generated_windows(contexts, 1200, seed=1), epochs=8)


def reached(text, lo, hi):
    starts = window_starts(text)
    return all(s in starts for s in every_start(text) if s <= lo and hi <= s + WIDTH)


def test_every_generated_positive_is_reached():
    lead = "words of plain prose " * 9
    some = 0
    for n, (w, spans) in enumerate(generated_windows(["plain prose without marks " * 4], 3000, seed=8)):
        for kind, lo, hi in spans:
            if hi <= len(w):
                text, at = lead[:n % 97] + w + " " + lead, n % 97
                assert accepted((kind, lo + at, hi + at), text), w[lo:hi]
                assert reached(text, lo + at, hi + at), w[lo:hi]
                some += 1
    assert some > 1500


@pytest.mark.parametrize("form", FORMS)
def test_spelled_addresses_are_accepted_and_reached(form):
    lead = "words of plain prose " * 9
    for shift in range(0, WIDTH, 5):
        text = lead[:shift] + form + " " + lead
        assert accepted((0, shift, shift + len(form)), text) and reached(text, shift, shift + len(form))


def test_word_ends_are_no_triggers():
    assert window_starts("the format of that matter is attached, a datum attests. Dots") == []
    assert not accepted((0, 4, 18), "form" + "at example.com")


def test_equal_to_decoding_every_window(tagger, contexts):
    r = random.Random(4)
    texts = [prose(r, 300) for _ in range(10)]
    for w, _ in generated_windows(contexts, 60, seed=21):
        texts.append(f"{prose(r, 40)} {w} {prose(r, 40)}")
    texts += [f"{prose(r, 50)} {form} {prose(r, 50)}" for form in FORMS]
    some = find_spans(texts, tagger)
    assert some == find_spans(texts, tagger, starts_of=every_start)
    assert sum(len(found) - len(base) for base, found in some) >= 20


def test_addresses_in_plain_prose_are_found(tagger):
    r, found = random.Random(3), 0
    for _ in range(40):
        lead = re.sub(r"[0-9@]", "", prose(r, 60)) + " "
        word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 7)))
        s = f"{word()}.{word()}{r.choice([' at ', ' AT ', '{at}', '[AT]'])}{word()} dot com"
        spans = find_spans([lead + s + " " + lead], tagger)[0][1]
        found += any(k == 0 and lo < len(lead) + len(s) and hi > len(lead) for k, lo, hi in spans)
    assert found >= 25
