import glob
import math
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from presslens.llm import tokens
from presslens.llm.kneser_ney import discounts, local_path, perplexity, score, scramble, train, unscramble
from presslens.llm.orc_tokens import read_tokens, token_digest, write_tokens
from presslens.llm.tokens import Encoder, definition, encoder
from presslens.session import shared_dir
from presslens.sources.tables import table
from tests.llm.helpers import awkward, docs_frame

ODD = ["", None, "  a b", "a  b", "a\tb", "\n", "a\n\nb c", "it's a 's 't", "x | y|z || |", "né́ ́x", "Ａ　Ｂ", "hello\x1cworld",
       "İstanbul ΣΑΣ ǅ", "<|endoftext|> ok", "a b c", "🎉 ok 🎉🎉", "12345 67.8%", " lead", "trail ", "a \n b", "one.two, three!",
       "x" * 5000, "ß.", "\x85 x", "é. é"]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_give_the_ids_of_the_whole_text(spark, name, spaces):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    enc = Encoder(definition(path), spaces)
    texts = ODD + [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    for text in texts + texts[:40]:  # from the cache too
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]


SPECIAL = ["<|endoftext|>", "a<|endoftext|> ok", "x <|startoftext|>y <|ENDOFTEXT|>", "one\ntwo <|endoftext|><|endoftext|>\n", "<|endoftext|", "no | such"]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_strings_as_in_the_plain_call(name, spaces):
    path = public_tokenizers.path(name)
    whole, enc = Tokenizer.from_file(path), encoder(definition(path), spaces)
    for text in SPECIAL + ODD:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]


STOPS = ["one, two. one, two.", "one,\ntwo.\n", "a), b.", "a.., b", "12, 3.5.", "a ,b, , c", "a,  b", "a\t, b", "a,\u00a0b", "it's, 's.", "_, é, é.", "क़, क़.",
         "Aİ, İ-", "İ.", ",", ". , .", "one,", "中, Ⅷ. ²,"]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_texts_together_give_the_ids_of_each(monkeypatch, name, spaces):
    path = public_tokenizers.path(name)
    whole, enc = Tokenizer.from_file(path), encoder(definition(path), spaces)
    texts = STOPS + ODD + SPECIAL
    want = [whole.encode(text or "", add_special_tokens=False).ids for text in texts]
    ids = lambda column: [np.frombuffer(b, "<u4").tolist() for b in column.to_pylist()]
    assert ids(enc.encode_all(texts)) == want
    assert ids(enc.encode_all([None, "", None])) == [[], [], []]
    monkeypatch.setattr(tokens, "PART_BYTES", 100)
    parts = list(enc.encode_rows(pa.array(texts)))
    assert len(parts) > 5 and [a for a, _ in parts] == np.cumsum([0] + [len(p) for _, p in parts])[:-1].tolist()
    assert [i for _, p in parts for i in ids(p)] == want
    assert list(enc.encode_rows(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_word_is_encoded_once_with_and_without_a_stop(name, spaces):
    enc, made = Encoder(definition(public_tokenizers.path(name)), spaces), []
    piece = enc.words.piece
    enc.words.piece = lambda key: made.append(key.strip()) or piece(key)
    for _ in range(2):
        enc.encode_all(["x ring the, ring. the ring,", None, "x the. ring, the"] * 50)
    assert sorted(made) == [",", ".", "ring", "the", "x"]


def test_files_of_texts_with_special_strings(spark):
    path, docs = shared_dir(spark, "t-special"), list(enumerate(SPECIAL))
    write_tokens(docs_frame(spark, [(i, x, "en", "a") for i, x in docs]), path, public_tokenizers.path("byte_bpe_50k.json"), shards=2)
    assert sorted(tuple(r) for r in token_digest(spark, path).collect()) == plain_digest(docs)


def plain_digest(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_back_all_ids(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    path = shared_dir(spark, "t-tokens")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), shards=5)
    want = plain_digest([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()])
    assert sorted(tuple(r) for r in token_digest(spark, path).collect()) == want
    files = sorted(glob.glob(urlparse(path).path + "/*.orc"))
    assert len(files) == 5
    ids = [i for f in files for i in orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist()]
    assert ids == sorted(ids)
    assert orc.ORCFile(files[0]).row_index_stride == 1000
    one = read_tokens(spark, path).where("doc_id = 77")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_files_of_awkward_rows(spark):
    docs = awkward(spark)
    path = shared_dir(spark, "t-tokens")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), shards=3)
    got = sorted(((tuple(r)) for r in token_digest(spark, path).collect()), key=lambda r: r[1])
    assert len(got) == 14
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))  # nulls first
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    want = Counter((i, n, c) for i, _, n, c in plain_digest([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert Counter((i, n, c) for i, _, n, c in got) == want
    empty = shared_dir(spark, "t-tokens")
    write_tokens(docs.where("false"), empty, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_digest(spark, empty).count() == 0


def plain_model(texts):
    tok = lambda t: (t or "").encode().lower().split() + [b" "]
    seqs = [tok(t) for t in texts]
    uni = Counter(w for s in seqs for w in s)
    big = Counter(p for s in seqs for p in zip([b" "] + s[:-1], s))
    before = Counter(w for _, w in big)
    d = discounts([sum(c == k for c in big.values()) for k in (1, 2, 3, 4)])
    e = discounts([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)])
    mass = Counter()
    for (v, _), c in big.items():
        mass[v] += d[min(c, 3) - 1]
    wide = sum(e[min(c, 3) - 1] for c in before.values())
    total, n = sum(uni.values()), len(uni)

    def prob(v, w):
        a = before[w]
        p = (a - e[min(a, 3) - 1] if a else 0) / len(big) + wide / len(big) / (n + 1)
        if uni[v]:
            c = big[(v, w)]
            p = (max(c - d[min(c, 3) - 1], 0) if c else 0) / uni[v] + mass[v] / uni[v] * p
        return p

    def scores(t):
        s = tok(t)
        return (len(s), sum(w in uni for w in s), total, sum(math.log10((uni[w] + .5) / (total + .5 * (n + 1))) for w in s),
                sum(math.log10(prob(v, w)) for v, w in zip([b" "] + s[:-1], s)))
    return scores, prob, uni


def test_scores_against_a_plain_model(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    learn = docs.where("doc_id % 5 <> 1")
    scores, prob, uni = plain_model([r["text"] for r in learn.collect()])
    model = train(learn)
    got = score(docs, model).withColumn("ppl", perplexity(score_col("score"), score_col("n_tokens"))).collect()
    for r in got:
        want = scores(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(want[3:], rel=1e-7)
        assert r["ppl"] == pytest.approx(10 ** (-want[4] / want[0]), rel=1e-6)
    held = [r for r in got if r["doc_id"] % 5 == 1]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # a distribution: all words, the end and the unknown word add up to one
    for v in [b" ", *list(uni)[:3]]:
        assert sum(prob(v, w) for w in uni) + prob(v, b"never seen") == pytest.approx(1)


def score_col(name):
    from pyspark.sql import functions as F
    return F.col(name)


def test_scores_of_awkward_rows(spark):
    docs = awkward(spark)
    scores, _, _ = plain_model([r["text"] for r in docs.collect()])
    got = score(docs, train(docs)).collect()
    assert len(got) == 14 and got[0]["uid"] == "u"
    for r in got:
        assert (r["n_tokens"], r["n_known"]) == scores(r["text"])[:2]
        assert r["score"] == pytest.approx(scores(r["text"])[4], rel=1e-7)
    empty = train(docs.where("false"))
    assert {r["score"] for r in score(docs, empty).collect()} == {0.0}
    assert score(docs.where("false"), empty).count() == 0
    same = docs_frame(spark, [(1, "a", None, None)] * 50)
    assert score(same, train(same)).where("score > 0").count() == 0


def test_pair_keys_are_one_to_one():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 32, (2, 1000))
    x, y = unscramble(scramble(a, b))
    assert (x == a).all() and (y == b).all()
    assert local_path("file:///a/b") == local_path("file:/a/b") == local_path("/a/b") == "/a/b"
    with pytest.raises(ValueError):
        local_path("hdfs://x/a")
