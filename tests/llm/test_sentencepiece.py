import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from odd_texts import ODD

from tripcast.llm import sentencepiece_bpe
from tripcast.llm.queries import tokenizer_path

spm = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")
PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=PATH)


def same(texts, library):
    ids, bounds = sentencepiece_bpe.model(PATH).encode(texts)
    want = library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert [x.decode() for x in sentencepiece_bpe.model(PATH).decode(ids, bounds)] == [library.decode(w) for w in want]


def test_odd_texts(library):
    same([t or "" for t in ODD] + ["aaaa" * 3000, "<s></s><unk><0x0A>", "\x00\t\r\n 　😀"], library)


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(" \n▁aābcehinrst<>/0x1的́😀"), max_size=60), max_size=8))
def test_random_texts(library, texts):
    same(texts, library)


def test_decode_of_any_ids(library):
    rng = random.Random(3)
    lists = [[rng.randint(0, 600) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    got = sentencepiece_bpe.model(PATH).decode(np.array([i for x in lists for i in x], np.int32), bounds)
    assert [g.decode() for g in got] == [library.decode(x) for x in lists]


def test_query_columns(docs_of, library):
    out = sentencepiece_bpe.encode_decode(docs_of(ODD, clash=True), PATH, digests=True).collect()
    for r in out:
        ids = library.encode(ODD[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    full = sentencepiece_bpe.encode_decode(docs_of(["a b"]), PATH).collect()
    assert full[0]["ids"] == library.encode("a b", add_bos=True, add_eos=True) and full[0]["decoded"] == "a b"
    assert sentencepiece_bpe.encode_decode(docs_of([]), PATH).count() == 0
