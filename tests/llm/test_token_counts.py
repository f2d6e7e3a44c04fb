import random

import pytest
from tokenizers import Tokenizer, models

from loadlens.llm import token_counts as C


@pytest.fixture(scope="module")
def vocab():
    return C.Vocabulary.read()


@pytest.fixture(scope="module")
def exact(vocab):
    tokenizer = Tokenizer(models.Unigram([*vocab.pieces], 0, True))
    return lambda text: len(tokenizer.encode(C.SPACE + text.replace(" ", C.SPACE)).ids) if text else 0


def test_counts_equal_the_tokenizer(docs, exact):
    rnd = random.Random(4)
    texts = [None, "", " ", "a", "  two  spaces ", "\n\n x\t", "héllo wörld €😀 漢字", "<s> <0x0A> x", "▁▁ ▁a", "aaaa" * 900, "the " * 5000, "x\u0000y"]
    texts += ["".join(rnd.choice("abc ▁éxyz\n  the<s>0😀") for _ in range(rnd.randrange(80))) for _ in range(300)]
    got = {r.doc_id: r.n_tokens for r in C.count_tokens(docs(list(enumerate(texts)))).collect()}
    assert got == {i: exact(t) for i, t in enumerate(texts)}


def test_documents_of_the_given_table(spark, sf, exact):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in C.count_tokens(df).collect()}
    assert got == {r.doc_id: exact(r.text) for r in df.collect()}


def test_empty_table(docs):
    assert C.count_tokens(docs([])).count() == 0


def test_ties_go_to_the_earlier_start():
    counter = C.Counter(C.Vocabulary((("<unk>", -9.0), ("a", -1.0), ("aa", -2.0), ("b", -1.0), ("ab", -2.0))))
    assert counter.count("aa") == 1 and counter.count("ab") == 1 and counter.count("é") == 2
