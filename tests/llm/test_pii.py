"""Personal data against the stated rules, and identifiers found by their contexts."""

import hashlib
import random
import re

from lakeproof.llm.pii import base_spans, candidates, emails, find_personal_data, parse_spans, patterns_of, redact_text, words_of
from tests.llm.fixtures import awkward, documents, prose

SAMPLES = [
    "mail a.b+c@d-e.co.uk, x@y no@dots@a.b.c. @z.z", "ip 1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1 010.020.030.0255 1.2.3", "card 4111 1111-1111 1111 and 4111111111111112",
    "call +1 (555) 010-9999 or +49-30-1234567890123456 or +1 2", "4532015112830366 7", "a@b.c@d.e +a@b.c", "12 345 6789 0123 4567", "aaaa@bbbb", "+1.2.3.4.5.6.7.8",
    "é@é.é ü.x@y.z", "user@host.tld.", "1.2.3.4@5.6.7.8",
]


def plain(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(digits))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def test_spans_equal_the_rules():
    draw = random.Random(2)
    alphabet = "ab1@.+- 0(9\n%"
    texts = SAMPLES + ["".join(draw.choice(alphabet) for _ in range(60)) for _ in range(3000)]
    texts += ["4" * n + "." + "1.2.3" for n in range(30)]
    for text in texts:
        assert base_spans(text) == plain(text), text


def test_long_runs_cost_no_retries():
    assert emails("a" * 300_000) == [] and emails("a@" * 100_000) == [] and base_spans("1" * 300_000) == []
    assert [s[0] for s in base_spans("1." * 100_000 + "x")] == ["ip"] * 25_000


def test_long_numbers_are_no_addresses_or_are():
    assert base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)] and base_spans("9" * 5000 + ".1.1.1") == []


def test_texts_of_a_million_characters(spark):
    texts = ["1" * 1_000_000, "a" * 1_000_000, "1a" * 500_000, "a1b2c3 " * 140_000, "x@y.z " * 160_000, "reach me: " + "a1" * 500_000 + " now"]
    found = find_personal_data(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r["n_email"] for r in found] == [0, 0, 0, 0, 160_000, 0]


def test_candidates_have_no_longest_length():
    long = "z9" * 300
    text = f'see "{long}", é12345é a@b.cd 1.2.3.4 x1 (ab-123-cd)'
    found = candidates(text, words_of(text), base_spans(text))
    assert [text[a:b] for a, b in found] == [long, "ab-123-cd"]


def test_patterns_of_all_widths():
    text = f"Dear Mr. {'x' * 50}, (a1234) Thanks a lot"
    words, start = words_of(text), text.index("a1234")
    assert patterns_of(text, words, start, start + 5, str) == ["x" * 50 + ", _", "Mr. " + "x" * 50 + ", _", "_ Thanks", "x" * 50 + ", _ Thanks"]
    assert patterns_of("a12345", words_of("a12345"), 0, 6, str) == [] and patterns_of("a12345 b", words_of("a12345 b"), 0, 6, str) == ["_ b"]


def test_recall_and_precision_on_planted_contexts(spark):
    """Identifiers of a form that no stated pattern knows, in contexts that seeds teach, beside harmless numbers."""
    draw = random.Random(8)
    private = ["reach me: {} thanks", "write to {} today", "account of {} was", "mr smith uses {}.", "login {} expired"]
    harmless = ["build number {} done", "chapter {} ends", "see page {} below", "model {} costs", "version {} of"]
    rows, planted, decoys = [], {}, {}
    for k in range(1200):
        kind, before, after = draw.randrange(4), prose(draw.randint(3, 9), k), prose(draw.randint(3, 9), -k - 1)
        made = "".join(draw.choice("abcdefgh0123456789-") for _ in range(draw.randint(8, 90))) + "x7"
        if kind == 0:
            value, frame = f"user{k}@mail{k % 7}.example.org", draw.choice(private)
        elif kind == 1:
            value, frame = f"id{made}", draw.choice(private)
            planted[k] = value
        else:
            value, frame = f"q{made}", draw.choice(harmless)
            decoys[k] = value
        rows.append((k, f"{before} {frame.format(value)} {after}"))
    texts = dict(rows)
    found = {
        r["doc_id"]: {texts[r["doc_id"]][a:b] for kind, a, b in parse_spans(r["spans"]) if kind == "context"}
        for r in find_personal_data(documents(spark, rows)).collect()
    }
    caught = sum(value in found[k] for k, value in planted.items())
    assert len(planted) > 250 and caught / len(planted) > 0.95
    assert caught / sum(map(len, found.values())) > 0.95


def test_counts_and_digest(spark):
    rows = awkward() + [(100 + k, t) for k, t in enumerate(SAMPLES)]
    found = find_personal_data(documents(spark, rows).repartition(3)).collect()
    expected = []
    for doc_id, text in rows:
        spans = plain(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((str(doc_id), *(sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")), hashlib.sha256(written.encode()).hexdigest(), written))
    columns = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in found) == sorted(expected)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"{prose(8, k)} reach me: user{k}@mail.example.org thanks") for k in range(40)]
    rows += [(100 + k, f"{prose(8, k)} reach me: user{k}(at)mail.example thanks") for k in range(5)]
    rows += [(200 + k, f"{prose(8, k)} build number v2.0.{k}rc1 done") for k in range(5)]
    found = {r["doc_id"]: (r["spans"], dict(rows)[r["doc_id"]]) for r in find_personal_data(documents(spark, rows)).collect()}
    for k in range(5):
        spans, text = found[100 + k]
        kind, start, end = spans.split(":")
        assert kind == "context" and text[int(start):int(end)] == f"user{k}(at)mail.example"
        assert found[200 + k][0] == ""
        assert redact_text(text, spans) == f"{prose(8, k)} reach me: [private] thanks"


def test_nothing_in_nothing_out(spark):
    assert find_personal_data(documents(spark, [])).collect() == []
