"""Line rules (10), personal data (5), packing (1), BPE (7): brute force and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chirpflow.llm import bpe, line_rules, packing, pii_crf

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), failed)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t#é|", max_size=120))
def test_line_rules_counts_equal_plain_ones(text):
    row = line_rules.judge(text.encode())
    assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"],
            row["base_failed"]) == plain_counts(text)


def test_line_rules_edges(edge, empty, edge_rows):
    got = line_rules.line_first_rules(edge).collect()
    assert len(got) == len(edge_rows)
    assert line_rules.line_first_rules(empty).collect() == []
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].n_words == 0 and by_id[4].base_failed and not by_id[4].kept
    assert by_id[1].kept and by_id[7].n_words == 20_000
    clean = {r.doc_id: r for r in line_rules.cleaned_texts(edge).collect()}
    assert clean[4].text is None and clean[1].text == by_id_text(edge_rows, 1)


def by_id_text(rows, doc_id):
    return next(t for d, t, _ in rows if d == doc_id)


def test_menus_with_and_without_spaces_go():
    for menu in ("Home | News | About", "Home|News|About", "Home | News | About | Sport", "a » b » c » d"):
        assert line_rules.line_rule(menu.encode(), len(menu.split()), set()) == "navigation", menu
    for text in ("one | two words here and many more of them | three.", "a | b", "no separator at all."):
        assert line_rules.line_rule(text.encode(), len(text.split()), set()) != "navigation", text


def test_lines_that_go():
    body = "A sentence that stays here for good reasons, as it ends well.\n" * 1
    text = body + "Home | News | About\nWe use cookies here.\nshort\n" + body
    kept, row = line_rules.clean_lines(text.encode())
    assert row["removed_rules"] == "boilerplate,navigation,punctuation,repeated" and row["n_removed_lines"] == 4
    assert b"\n".join(kept).decode().strip() == body.strip()


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii_crf.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-+1 025()%é\n", max_size=60))
def test_rule_spans_equal_the_plain_patterns(text):
    assert pii_crf.joined(pii_crf.rule_spans(text)) == plain_spans(text)


def test_rule_spans_on_known_values():
    text = "mail a.b@c.de.f, 10.0.0.256 10.0.0.25, 4111 1111 1111 1111 and +49 (171) 555-0123."
    assert pii_crf.joined(pii_crf.rule_spans(text)) == plain_spans(text) != ""
    assert [len(x) for x in pii_crf.rule_spans(text)] == [1, 1, 1, 1]


def test_luhn():
    assert pii_crf.luhn("4111111111111111") and not pii_crf.luhn("4111111111111112")


def test_potentials_count_all_documents(spark):
    texts = [f"order {i} of {i % 97}" if i % 600 else "card 4111 1111 1111 1111 or +49 (30) 123456" for i in range(6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = {}
    for t in texts:
        _, shapes, labels, edges = pii_crf.graph(t, pii_crf.rule_spans(t))
        for key in [(2, s, int(y)) for s, y in zip(shapes, labels)] + [(k, int(labels[i]), int(labels[j])) for i, j, k in edges]:
            counts[key] = counts.get(key, 0) + 1
    want = pii_crf.fit_potentials([(*k, n) for k, n in counts.items()])
    got = pii_crf.fit(docs.selectExpr("doc_id", "cast(text AS binary) AS text"))
    assert np.allclose(got["unary"], want["unary"]) and np.allclose(got["edges"], want["edges"])


def test_field_carries_labels_to_twins_and_matches_exact_inference():
    rng = np.random.default_rng(3)
    unary, edges = rng.normal(size=(4, 5)), np.array([[0, 1, 0], [1, 2, 0], [2, 3, 0]])
    psi = [rng.normal(size=(5, 5)), np.diag(rng.random(5))]
    joint = np.zeros((5, 5, 5, 5))
    for x in np.ndindex(joint.shape):
        joint[x] = sum(unary[i, x[i]] for i in range(4)) + sum(psi[k][x[i], x[j]] for i, j, k in edges)
    p = np.exp(joint) / np.exp(joint).sum()
    exact = np.stack([p.sum(tuple(k for k in range(4) if k != i)) for i in range(4)])
    assert np.allclose(pii_crf.beliefs(unary, edges, psi), exact, atol=1e-3)  # a chain: message passing is exact
    flat = {"unary": np.zeros((pii_crf.SHAPES + 1, 5)), "edges": [np.zeros((5, 5)), np.diag([4.0] * 5)]}
    text = "write to jo.doe@mail.example.org today\nor JO.DOE@MAIL.EXAMPLE.ORG\nnot 4012888 alone\nuser jo.doe@mail-example-org"
    (rules, more), = pii_crf.find_spans([text], flat)
    assert [text[a:b] for a, b in more[0]] == ["jo.doe@mail-example-org"] and len(rules[0]) == 2


@pytest.fixture(scope="module")
def field(spark):
    """Potentials of the whole documents table of sf0.1."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii_crf.fit(docs.selectExpr("doc_id", "cast(text AS binary) AS text"))


def spans_of(text, model):
    (rules, more), = pii_crf.find_spans([text], model)
    return [[(k, text[a:b]) for k, own in zip(pii_crf.KINDS, x) for a, b in own] for x in (rules, more)]


def test_twins_of_a_rule_span_get_its_kind(field):
    for text, kind, twin in (
            ("card 4111 1111 1111 1111 then 4111 1111 1111 1111 55", "card", "4111 1111 1111 1111"),
            ("ip 10.0.0.25 or 10-0-0-25 there", "ip", "10-0-0-25"),
            ("ring 0049 171 5550123 or +49 171 5550123 now", "phone", "0049 171 5550123"),
            ("call +491715550123 or 01715550123", "phone", "01715550123"),
            ("card 4111-1111-1111-1111 and 4111 1111 1111 1111 9 end", "card", "4111 1111 1111 1111"),
            ("jo.doe@mail.example.org and JO.DOE@mail-example-org", "email", "JO.DOE@mail-example-org")):
        rules, more = spans_of(text, field)
        assert {k for k, _ in rules} == {kind} and more == [(kind, twin)], text


def test_planted_mentions_that_rules_miss(field):
    """Recall and precision of the field on twins that no rule matches."""
    rng = random.Random(8)
    words = "the account was moved to another branch and nobody could say why this happened".split()
    found = planted = wrong = 0
    for _ in range(200):
        kind = rng.choice(pii_crf.KINDS)
        d = [str(rng.randint(0, 9)) for _ in range(12)]
        if kind == "email":
            name = "".join(rng.choice("abcdefgh") for _ in range(6))
            own, twin = f"{name}{d[0]}@mail.example.org", f"{name}{d[0]}@mail-example-org"
        elif kind == "ip":
            parts = [str(rng.randint(10, 255)) for _ in range(4)]
            own, twin = ".".join(parts), "-".join(parts)
        elif kind == "card":
            head = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
            own = next(head + c for c in "0123456789" if pii_crf.luhn(head + c))
            own = " ".join(own[i:i + 4] for i in range(0, 16, 4))
            twin = own + " 7" if not pii_crf.luhn(own.replace(" ", "") + "7") else own + " 8"
        else:
            own = f"+49 17{d[0]} 555{''.join(d[1:5])}"
            twin = "0049" + own[3:]
        text = " ".join([*rng.sample(words, 4), own, *rng.sample(words, 4), twin, *rng.sample(words, 3)])
        rules, more = spans_of(text, field)
        planted += 1
        found += any(k == kind and v in twin for k, v in more)
        wrong += sum(k != kind for k, _ in more)
    print("planted", planted, "found", found, "of another kind", wrong)
    assert found >= 0.9 * planted and wrong <= 0.02 * planted


def test_a_lone_token_is_judged_alike_in_every_document(field):
    for lone in ("10-0-0-25", "4111111111111112", "01715550123", "jo@localhost"):
        alone = spans_of(f"text {lone} text", field)[1]
        beside = spans_of(f"text {lone} text. And so on, then 5550123 and 5550123 again", field)[1]
        assert alone == [] and not [x for x in beside if x[1] == lone]


def test_numbers_are_no_personal_data(field):
    for text in ("order 4111 of 1111 and 2222", "in 2019 and 2020, 1500 and 1500", "pages 10-12 and 10-12, section 3.1.2 and 3.1.2",
                 "v1.2.3.400 and v1.2.3.400"):
        assert spans_of(text, field) == [[], []], text


def test_shape_reads_whole_tokens_and_any_bytes(spark):
    assert pii_crf.shape("1" * 100 + "a") != pii_crf.shape("1" * 101)
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'ff61204040203132' AS STRING) AS text")
    (row,) = pii_crf.personal_data(docs).collect()
    assert row.spans == ""


def test_personal_data_edges(edge, empty, edge_rows):
    got = pii_crf.personal_data(edge).collect()
    assert len(got) == len(edge_rows) and pii_crf.personal_data(empty).collect() == []
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    assert pii_crf.masked(edge).collect() == edge.collect()
    assert pii_crf.masked(empty).columns == empty.columns
    assert pii_crf.mask("x a@b.c y", [[(2, 7)], [], [], []], [[], [], [], [(2, 3)]]) == "x <EMAIL> y"


def test_linear_time_on_long_runs():
    for text in ("9" * 300_000, "a" * 300_000, "1.2." * 80_000, "a@" * 100_000, "+1 " * 100_000):
        pii_crf.rule_spans(text)
        pii_crf.tokens(text)


def test_words_encoded_in_lines_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(alphabet="aB'st é\u0301\u0327ﬁ1日🙂\u00a0\u2028\x1c.-<|endoftext|>\u1100\u1161\n", max_size=30), max_size=90))
    def holds(texts):
        own = packing.WordEncoder(path)
        for _ in range(2):  # fresh, then from the memo
            got = [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])]
            assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    holds()
    own = packing.WordEncoder(path)
    marked = ["end <|endoftext|> of<|startoftext|>text", "<|endoftext|>", "a <| b |> c"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in marked])] == [
        plain.encode(t, add_special_tokens=False).ids for t in marked]
    assert own.encode([b"ab\xff cd"]) == own.encode(["ab\ufffd cd".encode()])


def test_packing_covers_every_id_once(edge, empty, edge_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want = sorted(tuple([*plain.encode(t or "", add_special_tokens=False).ids, 1]) for _, t, _ in edge_rows)
    got = packing.pack(edge, path).collect()
    seqs, total = {}, 0
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
        total += r.length
        assert r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert total == sum(map(len, want))
    for s, pieces in seqs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or s == max(seqs)
    stream = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    docs, own = [], []
    for r in stream:  # the pieces of a document follow each other in the stream
        assert r.start == len(own)
        own += np.frombuffer(r.ids, "<u4").tolist()
        if len(own) == r.doc_tokens:
            docs.append(tuple(own))
            own = []
    assert sorted(docs) == want
    assert packing.pack(empty, path).collect() == []


def test_bpe_equals_the_library(edge, empty, edge_rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path),
                            special_tokens={})
    want = sorted((str(d), t or "", enc.encode_ordinary(t or "")) for d, t, _ in edge_rows)
    got = bpe.encode_texts(edge, path, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode(), list(r.ids)) for r in got) == want
    digests = bpe.digests(edge, path, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == sorted(
        (d, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
         hashlib.sha256(t.encode()).hexdigest()) for d, t, i in want)
    assert bpe.digests(empty, path, public_tokenizers.PATTERN).collect() == []


def test_bpe_on_any_text():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.Coder(path, public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.text(max_size=60), max_size=5))
    def holds(texts):
        for text, (ids, n, decoded) in zip(texts, own.code(texts)):
            want = enc.encode_ordinary(text)
            assert ids == " ".join(map(str, want)) and n == len(want) and decoded.decode() == text
    holds()
    long = "abcdefgh" * 200
    assert bpe.contract(long.encode(), own.ranks) == enc.encode_ordinary(long)


def test_case_of_ascii_texts_costs_no_second_spelling():
    """Spellings that the tokenizer lower-cases anyway are one entry of the memo; marks of
    special tokens and other alphabets keep their case."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.WordEncoder(path)
    own.encode([b"Tail tail TAIL taiL", b"", b"tail"])
    assert set(own.memo) == {b"tail"}
    texts = ["The END the end", "<|STARTOFTEXT|> A a <|startoftext|>x", "T\u0308 t\u0308 I\u0307 i\u0307 \u212aelvin K", "It'S IT's", ""]
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])] == want
