import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessella.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéèßüñÀÇ'0123456789 \n\t.,!?%&*$-_AEIOU"
    out = ["", None, " ", "I'll we've it's THE <|endoftext|>end<|startoftext|>", "<|ENDOFTEXT|>", "x" * 3000, "\x1c\x1d a\x85b\xa0c"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(300)]
    words = "the international misunderstanding photographers token antidisestablishmentarianism onenonwhtible schgech".split()
    out += [" ".join(rng.choice(words) + rng.choice(["", "s", "ing", "ly", "tion", "!!", "%%%"]) for _ in range(60)) for _ in range(30)]
    out += ["ΟΔΥΣΣΕΥΣ Σίσυφος İstanbul", "漢字かな交じり文 é ﬁ", "👩‍👩‍👧 emoji 😀😀", "".join(chr(rng.randint(32, 0x2FFF)) for _ in range(500)), "aaaaaaaaaaa ababababab"]
    return out


def test_words_as_the_library(library):
    encoder = bpe.encoder(PATH)
    for text, words in zip(texts(), encoder.parts(texts()), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        got = [i for w in words for i in w[0]]
        assert got == want, repr(text)
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_digests_ids_and_clashing_columns(spark, library):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in bpe.encoding_digests(df, PATH).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    clash = spark.createDataFrame([(1, "A b", "x", 5), (None, None, "y", 6)], "doc_id long, text string, ids string, n_tokens int")
    full = bpe.decode(bpe.encode(clash, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in full) == [("1", 2, "a</w> b</w>"), ("None", 0, "")]
    assert bpe.encode(clash.limit(0), PATH).collect() == []
