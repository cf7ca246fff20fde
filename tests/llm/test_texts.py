"""Personal data, tokens, packing, grammar files, quality, decontamination, chat, shards."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fernwell.llm import chat, decontaminate, grammar, packing, pii, quality, sharding, tokens
from fernwell.llm.queries import tokenizer_file

EDGE = ["", " ", "a  b", "a \n b\n", "don't I'LL we're", "x y   z", "日本語 テスト ３ ½", "İstanbul ΣΑΣ ς", "é é Å Å", "\t\tx\ty\r\n", "<|endoftext|> hi", "a b  c", "\x1c \x1d x", "--- ... !!!'s", "  lead", "trail  ", "\u0085 x", "😀😀 x", "a\x01b c", "ñ¡¿ª º", "µ × ÷"]

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans():
    r = random.Random(3)
    for _ in range(40_000):
        s = "".join(r.choice("a1+@. -(2)") for _ in range(r.randrange(24)))
        assert brute_spans(s) == pii.base_spans(s)[0], s
    assert pii.base_spans("1" * 200_000)[0] == [] and pii.base_spans("a" * 200_000)[0] == []


def test_personal_data(spark):
    trees, limits = pii.model()
    kinds = lambda t: [pii.KINDS[k] for _, k, _ in pii.find(t, trees, limits)[1]]
    assert kinds("mail me at bob (at) example.com now") == ["email"]
    assert kinds("call (555) 123-4567 ok") == ["phone"]
    assert kinds("x 9870157079875996 y") == [] and kinds("order 555-123-4567 is") == []
    rows = [(1, "to a.b@mail.de or +1 (499) 555-6503 ü"), (1, "to a.b@mail.de or +1 (499) 555-6503 ü"), (2, None), (3, ""), (4, "4111 1111 1111 1111 and 10.0.0.1")]
    df = spark.createDataFrame([(i, t, 5, "q") for i, t in rows], "doc_id long, text string, n_chars long, spans string")
    got = {r.doc_id: r for r in pii.scan(df).collect()}
    assert got[1].spans == "email:3:14,phone:18:35" and got[2].spans == "" and (got[4].n_card, got[4].n_ip) == (1, 1)
    red = {r.doc_id: (r.text, r.n_chars, r.spans) for r in pii.redact(df).collect()}
    assert red[1] == ("to [EMAIL] or [PHONE] ü", 23, "q") and red[2] == (None, 5, "q") and red[4][0] == "[CARD] and [IP]"
    assert pii.scan(df.limit(0)).count() == 0


def test_added_spans_on_texts_of_their_own():
    """Cues, names and formats that neither training nor calibration has."""
    trees, limits = pii.model()
    assert len(set(limits)) > 2
    x, y, kinds = pii.samples(99, 3000, 2)
    took = trees.predict(x) >= np.array(limits)[kinds]
    assert y[took].mean() > 0.95 and y[took].sum() > 0.95 * y.sum()


def test_secrets(spark):
    key = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    rows = [(1, f'ab token = "{key}" cd'), (2, f"commit {key} of"), (3, "a-very-long-word-without-digits " * 3), (4, "7" * 100_000), (5, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_added int")
    got = {r.doc_id: (r.spans, r.n_added, r.n_spans) for r in pii.scan(df).collect()}
    assert got == {1: ("secret:12:52", 1, 1), 2: ("", 0, 0), 3: ("", 0, 0), 4: ("", 0, 0), 5: ("", 0, 0)}
    assert {r.doc_id: r.text for r in pii.redact(df).collect()}[1] == 'ab token = "[SECRET]" cd'


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    from tokenizers import Tokenizer

    path = tokenizer_file(name)
    own = Tokenizer.from_file(path)
    r = random.Random(4)
    marked = ["hello <|endoftext|> world", "<|startoftext|><|endoftext|>", " a<|endoftext|>  b\n<|startoftext|>é", "<|ENDOFTEXT|> <|endoftext", "|>"]
    texts = EDGE + marked + ["".join(r.choice("ab'sé Ü1.,\n\t  ñLL") for _ in range(r.randrange(80))) for _ in range(300)]
    want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    got = [ids[o[i] : o[i + 1]].tolist() for _, o, ids in tokens.encode_texts(path, pa.array(texts), 500) for i in range(len(o) - 1)]
    assert got == want
    assert tokens.odd_tokens(path) == []


def test_cuts_are_optimal():
    r = random.Random(6)
    for _ in range(60):
        places = np.array([0, *sorted(r.sample(range(1, 60), 9)), 60])
        pen = np.array([0, *[r.randrange(6) for _ in range(9)], 0])
        cap = 20
        if np.diff(places).max() > cap:
            continue
        best = {0: 0.0}
        for j in range(1, len(places)):
            best[j] = min((best[i] + cap - (places[j] - places[i]) + pen[j] for i in range(j) if i in best and places[j] - places[i] <= cap), default=np.inf)
        cuts = packing.cut_windows(places, pen, cap)
        cost = sum(cap - (places[b] - places[a]) + pen[b] for a, b in zip([0, *cuts[:-1]], cuts))
        assert cost == best[len(places) - 1]


def test_packing(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = [(i, "A word or two. " * n) for i, n in enumerate([0, 1, 3, 50, 400, 900, 2, 2])] + [(99, None), (5, "again")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length int").coalesce(1)
    got = packing.pack(df, path, windows=2).collect()
    by_seq: dict = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_seq.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 1024
    tokens_of = Counter()
    for r in got:
        tokens_of[r.doc_id] += r.length
    assert all(tokens_of[r.doc_id] == r.doc_tokens for r in got if r.doc_id != 5)
    assert packing.pack(df.limit(0), path).count() == 0


def test_grammar_round_trip():
    r = np.random.default_rng(0)
    for n, span in ((0, 5), (1, 5), (5000, 7), (20000, 300)):
        ids = r.integers(0, span, n).astype(np.uint16)
        starts = np.unique(np.concatenate(([0], np.sort(r.integers(0, n + 1, 9)), [n])))
        starts = np.sort(np.concatenate((starts, starts[1:2])))
        s = grammar.Shard(grammar.compress(ids, starts, 400, least=2))
        assert (s.all_ids() == ids).all()
        for i in range(len(starts) - 1):
            doc = ids[starts[i] : starts[i + 1]]
            assert (s.document(i) == doc).all() and (s.document(i, 3, 11) == doc[3:11]).all()
    loop = grammar.Shard(grammar.compress(np.array([1, 2] * 500, np.uint16), np.array([0, 1000]), 400, least=2))
    assert len(loop.seq) < 200


def test_token_files(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    rows = [(i, f"some words {i} again and again " * (i % 7)) for i in range(60)] + [(70, None), (71, "x <|endoftext|> y"), (3, "twice")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in grammar.through_files(df, path).collect())
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    assert [g[1] for g in got] == sorted(i for i, _ in rows)
    crc = {i: zlib.crc32(np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows if i != 3}
    assert all(crc[i] == c for _, i, _, c in got if i != 3)
    assert grammar.through_files(df.limit(0), path).count() == 0


def test_quality(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("aeioubdkl") for _ in range(r.randrange(2, 7)))
    good = lambda: " ".join(word() for _ in range(60)).capitalize() + "."
    junk = lambda: " ".join([word().upper() + "!!"] * 30)
    rows = [(i, junk() if i % 4 == 0 else good()) for i in range(400)] + [(900, None), (901, "")]
    docs = spark.createDataFrame([(i, t, "en", 0.0) for i, t in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(7, None, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.score_documents(docs, labels).collect()}
    held = [x for x in got.values() if x.held_out and x.doc_id < 400]
    assert len(held) > 40 and sum(x.predicted == (x.doc_id % 4 != 0) for x in held) >= 0.95 * len(held)
    assert got[900].score == got[901].score and all(x.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, x in got.items())
    assert quality.keep_good(docs, labels).columns == docs.columns
    none = {x.score for x in quality.score_documents(docs, labels.limit(0)).collect()}
    assert none == {0.5}
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_decontamination(spark):
    r = random.Random(9)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, f"{text(14)}. {text(12)}.") for i in range(12)] + [(50, None), (51, "")]
    docs = [(i, text(200)) for i in range(40)] + [(90, None), (91, ""), (92, "short")]
    docs += [(100 + i, f"{text(70)} {t} {text(50)}") for i, t in items[:6]]
    words = items[7][1].split()
    words[3] = words[9] = "changed"
    docs += [(200, f"{text(40)} {' '.join(words)} {text(30)}"), (201, f"{text(40)} {items[8][1].split('.')[0]} {text(90)}"), (100, docs[43][1])]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, cosine int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find(d, b, chunk_items=5).collect()}
    assert got == {(100 + i, i) for i in range(6)} | {(200, 7)}
    kept = {x.doc_id for x in decontaminate.drop_contaminated(d, b).collect()}
    assert kept == {i for i, _ in docs} - {100 + i for i in range(6)} - {200}
    assert decontaminate.find(d, b.limit(0)).count() == 0 and decontaminate.find(d.limit(0), b).count() == 0


def test_decontamination_beyond_the_rank(spark):
    r = random.Random(10)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randrange(40, 60))) for i in range(200)]
    docs = [(i, f"{text(r.randrange(60))} {t} {text(50)}") for i, t in items]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find(d, b, rank=16).collect()}
    assert got == {(i, i) for i, _ in items}


def test_decontamination_of_short_items(spark):
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    often = vocab[:40]
    text = lambda n, of: " ".join(r.choice(of) for _ in range(n))
    items = [(n, text(n, often)) for n in (1, 2, 3, 4, 5, 6, 8, 10, 12, 16)]
    docs = [(1000 * n + k, f"{text(k, vocab)} {t} {text(40, vocab)}") for n, t in items for k in range(32)]
    docs += [(-i, text(60, often)) for i in range(1, 30)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find(d, b).collect()}
    assert got >= {(1000 * n + k, n) for n, _ in items for k in range(32)}


def test_subsequence():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randrange(1, 12))] for _ in "ab")
        f = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                f[i + 1][j + 1] = f[i][j] + 1 if x == y else max(f[i][j + 1], f[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate._bits(np.array(a)), len(a), b) == f[-1][-1]


def test_preference_pairs(spark):
    schema = "pair_id long, turn long, role string, text string, extra int"
    c = [(1, 0, "user", "hi", 0), (1, 0, "user", "hi", 0), (1, 1, "assistant", "yes", 0), (2, 0, None, None, 0), (3, 0, "user", "x", 0)]
    j = [(1, 0, "user", "hi", 0), (1, 1, "assistant", "no", 0), (1, 2, "user", "so", 0), (3, 0, "user", "x", 0)]
    got = {r.pair_id: r for r in chat.preference_pairs(spark.createDataFrame(c, schema), spark.createDataFrame(j, schema)).collect()}
    one = got[1]
    assert one.prompt == "<|im_start|>user\nhi<|im_end|>\n" and one.n_prompt_turns == 1
    a, z = map(int, one.chosen_loss.split(":"))
    assert one.chosen[a:z] == "yes<|im_end|>" and one.rejected.endswith("so<|im_end|>\n") and one.rejected_loss.count(":") == 1
    assert (got[2].prompt, got[2].rejected, got[2].chosen) == ("", "", "<|im_start|>user\n<|im_end|>\n")
    assert got[3].chosen == got[3].rejected == got[3].chosen_loss == "" and got[3].n_prompt_turns == 1
    empty = spark.createDataFrame([], schema)
    assert chat.preference_pairs(empty, empty).count() == 0


def test_jump_hash_and_slots(spark):
    keys = np.arange(-50_000, 50_000)
    for n in (1, 2, 8, 100):
        a, b = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        assert ((a == b) | (b == n)).all() and abs((b == n).mean() - 1 / (n + 1)) < 0.01 and a.max() < n
    rows = [(i, "x" * (i % 5)) for i in range(3000)] + [(None, None), (7, "dup"), (7, "dup")]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, shard int, law string")
    got = sharding.shard_documents(df).collect()
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in got) and len(got) == len(rows)
    assert sharding.shard_documents(df.limit(0)).count() == 0
