"""Patterns against plain regular expressions, and what the field adds."""

import random
import re

import numpy as np

from textlab.llm import pii
from textlab.llm.pii import KINDS, base_spans, find_pii, redact

from .texts import frame, with_clashes

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        odd = sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
        return 16 <= len(d) <= 19 and odd % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def plain(text):
    return [(k, *m.span()) for k, kind in enumerate(KINDS) for m in re.finditer(PATTERNS[kind], text or "") if holds(kind, m[0])]


def texts():
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        bits = [rnd.choice(["call", "mail", "the", "é", "token", "x"]) for _ in range(rnd.randint(0, 20))]
        for _ in range(rnd.randint(0, 3)):
            n = rnd.randint(0, 9999)
            bits.insert(rnd.randint(0, len(bits)), rnd.choice([f"a.{n}@mail.example.com", f"10.{n % 256}.3.{n % 300}", "4539 1488 0343 6467", "4539148803436467,", f"+1 (555) 555-{n:04d}", str(n)]))
        rows.append((i, " ".join(bits)))
    return rows + [(300, None), (301, ""), (302, "9" * 20_000 + " a@b.c " * 2000), (None, "x@y.zz"), (7, "x@y.zz"), (7, "x@y.zz")]


def test_patterns_on_random_strings():
    rnd = random.Random(1)
    for _ in range(20_000):
        s = "".join(rnd.choice("ab.@-+ 0123456789 .@()é4_%") for _ in range(rnd.randint(0, 60)))
        assert base_spans(s) == plain(s), s


def test_long_texts_take_linear_time():
    s = "1" * 300_000 + " " + "a" * 300_000 + "@" * 1000 + "+1 " * 50_000 + "1." * 100_000
    assert len(base_spans(s)) >= 0


def test_base_stays_and_spans_are_in_order(spark):
    rows = texts()
    got = find_pii(with_clashes(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        spans = [(KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        base = [(KINDS.index(s.kind), s.start, s.end) for s in r.base]
        assert set(base) <= set(spans) and spans == sorted(spans) and base == sorted(base)
        by[r.doc_id, r.redacted] = base
    for i, t in rows:
        match = [b for (j, _), b in by.items() if j == i]
        assert plain(t) in match


def test_skip_edges_carry_a_label_to_a_repeat(spark):
    train = [(i, f"please call +1 (555) 555-{i:04d} now or later and then go") for i in range(300)]
    train += [(1000 + i, f"we counted 55{i:05d} of them in the box today") for i in range(300)]
    one = (5000, "please call +1 2025550143 now. " + "word " * 50 + "again 12025550143, thanks")
    got = {r.doc_id: r for r in find_pii(frame(spark, train + [one])).collect()}
    assert all(not got[1000 + i].spans for i in range(300))
    w = np.zeros((pii.WIDTH + 15, 5))
    w[pii.WIDTH + 10 :] = 4 * np.eye(5)
    p = pii.marginals(w, np.zeros((3, 6), int), np.array([0, 4, 0]), np.zeros((0, 2), int), np.array([[0, 1]]))
    assert p[0].argmax() == 4 and p[0, 4] > 0.9 and abs(p[2, 4] - 0.2) < 1e-9


def test_message_passing_is_exact_on_a_tree():
    rnd = np.random.default_rng(0)
    w = np.zeros((pii.WIDTH + 15, 5))
    w[: pii.WIDTH] = rnd.standard_normal((pii.WIDTH, 5))
    w[pii.WIDTH :] = rnd.standard_normal((15, 5))
    x = rnd.integers(0, pii.WIDTH, (4, 6))
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3]])
    got = pii.marginals(w, x, np.zeros(4, int), chain, skip, rounds=60)
    left, right, far = w[pii.WIDTH : pii.WIDTH + 5], w[pii.WIDTH + 5 : pii.WIDTH + 10], w[pii.WIDTH + 10 :]
    near, same, unary = (left + right.T) / 2, (far + far.T) / 2, w[x].sum(axis=1)
    total = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        s = np.exp(sum(unary[i, y[i]] for i in range(4)) + near[y[0], y[1]] + near[y[1], y[2]] + same[y[1], y[3]])
        for i in range(4):
            total[i, y[i]] += s
    assert np.allclose(got, total / total.sum(axis=1, keepdims=True), atol=1e-6)


def test_redaction_and_nothing(spark):
    assert redact("mail a@b.cc or +1 555 5555 55", [(0, 5, 11), (3, 15, 29)]) == "mail <email> or <phone>"
    assert redact("abcdef", [(1, 1, 4), (2, 2, 6)]) == "a<ip>"
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_an_entity_found_once_is_found_wherever_it_is_repeated(spark):
    train = [(i, f"please call +1 (555) 555-{i:04d} now or later and then go") for i in range(300)]
    train += [(1000 + i, f"we counted 55{i:05d} of them in the box today") for i in range(300)]
    phone = "please call +1 2025550143 now. " + "again 12025550143, thanks " * 30
    card = "card 4539 1488 0343 6467 or " + "word " * 50 + "4539 / 1488 / 0343 / 6467 and 4539.1488 0343.6467 but 4539 1488 of 6467"
    got = {r.doc_id: r for r in find_pii(frame(spark, train + [(5000, phone), (5001, card)])).collect()}
    assert all(not got[1000 + i].spans for i in range(300))
    found = [phone[s.start : s.end] for s in got[5000].spans if s.kind == "phone"]
    assert found == ["+1 2025550143"] + ["12025550143"] * 30
    found = [card[s.start : s.end] for s in got[5001].spans if s.kind == "card"]
    assert found == ["4539 1488 0343 6467", "4539.1488 0343.6467"]


def test_messages_reach_the_end_of_a_long_skip_path():
    w = np.zeros((pii.WIDTH + 15, 5))
    w[pii.WIDTH + 10 :] = 12 * np.eye(5)
    n = 40
    p = pii.marginals(w, np.zeros((n, 6), int), np.array([4] + [0] * (n - 1)), np.zeros((0, 2), int), np.array([[i, i + 1] for i in range(n - 1)]))
    assert p[:, 4].min() > 0.99
