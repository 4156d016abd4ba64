import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from helpers import EDGES, edges, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from wavelens.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
TRUE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
MINE = bpe.encoder(PATH, P.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab teh\n\t'sdé漢 12²!?　\x1c\xa0\U0001f642"), max_size=60))
def test_every_text_is_encoded_as_the_library_does(text):
    assert list(MINE.encode(text)) == TRUE.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 20_000, " " * 5000 + "x", "\n" * 300 + " a", "thethetion" * 300])
def test_long_words_take_linear_time(text):
    assert list(MINE.encode(text)) == TRUE.encode_ordinary(text)


def test_random_bytes_as_one_word():
    rng = random.Random(1)
    for _ in range(300):
        word = bytes(rng.choice(b"the ingabcd\xc3\xa9\xff\x00") for _ in range(rng.randrange(1, 40)))
        assert MINE.vocabulary.encode_word(word) == TRUE._encode_single_piece(word)


def test_what_is_remembered_stays_bounded():
    seen = bpe.Memo(lambda x: x + 1, 10)
    assert [seen[i % 25] for i in range(200)] == [i % 25 + 1 for i in range(200)] and len(seen) + len(seen.older) <= 11


def test_edges_and_a_clashing_column(spark):
    df = edges(spark).withColumnRenamed("ROW", "IDS")
    back = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH).collect()
    got = sorted((str(r["doc_id"]), r["text"] or "", list(r["ids"]), bytes(r["decoded"])) for r in back)
    want = sorted((str(i), t or "", TRUE.encode_ordinary(t or ""), (t or "").encode()) for i, t in EDGES)
    assert got == want and "IDS" not in back[0].asDict()


def test_no_rows(spark):
    assert bpe.decode(bpe.encode(empty(spark), PATH, P.PATTERN), PATH).count() == 0


def test_an_unknown_id_is_an_error():
    with pytest.raises(ValueError):
        bpe.decoder(PATH).decode(bpe.np.array([50_300]))


def test_query_digests(spark):
    from wavelens.llm.registry import op1_bpe

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op1_bpe(spark, sf).collect():
        ids = TRUE.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
