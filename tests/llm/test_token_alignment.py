"""Token alignment against whole-text encoding and plain counting."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from odd_rows import FOLDER, no_docs, odd_docs  # noqa: F401  fixtures

from patronscope.llm import queries, token_alignment as align


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(tokenizers, text):
    """n_a, n_b, groups and links of one text, encoded as a whole."""
    a, b = tokenizers
    if not text:
        return 0, 0, [], []
    back = align.byte_level_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return 0, 0, [], []

    def spans(parts):
        at, found = 0, []
        for p in parts:
            found.append((at, at + len(p)))
            at += len(p)
        return found

    sa, sb = spans(bytes_a), spans(bytes_b)
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, links = [], []
    x = y = 0
    for end in ends:
        own_a, own_b = [], []
        while x < len(sa) and sa[x][1] <= end:
            own_a.append(x)
            x += 1
        while y < len(sb) and sb[y][1] <= end:
            own_b.append(y)
            y += 1
        groups.append(f"{','.join(str(ids_a[i]) for i in own_a)}|{','.join(str(ids_b[i]) for i in own_b)}")
        links += [(ids_b[j], ids_a[i]) for i in own_a for j in own_b if sa[i][0] < sb[j][1] and sb[j][0] < sa[i][1]]
    return len(ids_a), len(ids_b), groups, links


def expected(tokenizers, texts):
    found = [plain(tokenizers, t) for t in texts]
    count = Counter(x for f in found for x in f[3])
    top = {}
    for (b, _), n in count.items():
        top[b] = max(n, top.get(b, 0))
    rows = [(f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == top[x[0]] for x in f[3]), sum(count[x] for x in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest() if f[0] else "") for f in found]
    return rows, count, top


def odd_texts():
    rng = random.Random(6)
    parts = ["a", "Word", " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", "　", "​", "é", "日本", "😀", "'s", "n't", "12", "…", "<s>", "</s>", "<unk>",
             "<0x0A>", "<|endoftext|>", "ab", "\x00", "́", "ﬁ", "Ⅷ", "##", "﻿", "᠎", "\x0b", "\x0c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    return texts + [None, "", " ", "  ", "\n", " \n", "\n ", "a ", " a", "with ▁ inside", "▁", "x" * 3000, "a\n\nb  c\td \n e"]


def test_pieces_of_a_text_are_encoded_as_the_whole_is(tokenizers):
    texts = odd_texts()
    aligner = align.Aligner(public_tokenizers.path(align.TOKENIZER_A), public_tokenizers.path(align.TOKENIZER_B))
    sums, written, doc, pair, links = aligner.align(texts)
    found = [Counter() for _ in texts]
    for d, p, n in zip(doc.tolist(), pair.tolist(), links.tolist()):
        found[d][p >> 16, p & 0xFFFF] += n
    for text, row, groups_text, own in zip(texts, sums.tolist(), written, found):
        n_a, n_b, groups, all_links = plain(tokenizers, text)
        assert (*row, groups_text.decode()) == (n_a, n_b, len(groups), len(all_links), ";".join(groups)), repr(text)
        assert own == Counter(all_links)


@pytest.mark.parametrize("spill,fan,pairs", [(1, 2, 1), (500, 3, 7), (align.SPILL_RECORDS, align.FAN_IN, align.COUNT_PAIRS)])
def test_counts_of_a_corpus_against_plain_counting(spark, tokenizers, monkeypatch, spill, fan, pairs):
    monkeypatch.setattr(align, "FAN_IN", fan)
    monkeypatch.setattr(align, "COUNT_PAIRS", pairs)
    monkeypatch.setattr(align, "CHUNK_CHARACTERS", 300 if spill == 1 else 1 << 20)
    texts = odd_texts()[:120] + ["the cat and the dog", "the cat", None, "", "the cat"] * 5
    docs = spark.createDataFrame([(i % 100, t, "x", 1) for i, t in enumerate(texts)], "doc_id int, text string, document string, spill int").repartition(3)
    order = [r["text"] for r in docs.collect()]
    rows, count, top = expected(tokenizers, order)
    found = align.align(docs, with_groups=True, spill_records=spill)
    got = found.documents.select("document.doc_id", "alignment.*").collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(rows)
    assert found.documents.select("document.*").columns == ["doc_id", "document", "spill"]
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got if r["n_a"])
    assert {(r["b"], r["a"]): (r["links"], r["best"]) for r in found.pairs.collect()} == {k: (n, n == top[k[0]]) for k, n in count.items()}


def test_odd_rows_and_no_rows(odd_docs, no_docs, tokenizers):
    found = align.align(odd_docs).documents
    assert found.count() == odd_docs.count() and "text" not in found.select("document.*").columns
    zero = found.where("alignment.n_a = 0").select("alignment.*").collect()
    assert zero and all(tuple(r) == (0, 0, 0, 0, 0, 0, "") for r in zero)
    empty = align.align(no_docs)
    assert empty.documents.count() == 0 and empty.pairs.count() == 0


def test_query_against_plain_python(spark, tokenizers):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows, _, _ = expected(tokenizers, list(texts.values()))
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.queries()["op12_token_alignment"](spark, FOLDER).collect()}
    assert got == dict(zip(texts, rows))
