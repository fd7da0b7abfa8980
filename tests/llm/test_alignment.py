"""Alignment of two tokenizers against a walk over their tokens, one at a time."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfmark.llm import alignment
from shelfmark.llm.common import prepared
from shelfmark.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def letters():
    """Bytes that print stand for themselves, the others for letters from 256 on, in order."""
    found, spare = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 255 and byte != 173:
            found[chr(byte)] = byte
        else:
            found[chr(spare)] = byte
            spare += 1
    return found


LETTERS = letters()


def bytes_of_b(token):
    piece = B.id_to_piece(token)
    return bytes.fromhex(piece[3:5]) if B.is_byte(token) else piece.replace("▁", " ").encode()


def groups_of(text):
    a = A.encode(" " + text, add_special_tokens=False).ids if text else []
    b = B.encode(text) if text else []
    bytes_a = [bytes(LETTERS[c] for c in A.id_to_token(t)) for t in a]
    bytes_b = [bytes_of_b(t) for t in b]
    if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends = [set(), set()]
    for side, parts in enumerate((bytes_a, bytes_b)):
        at = 0
        for part in parts:
            at += len(part)
            ends[side].add(at)
    groups = {end: ([], []) for end in sorted(ends[0] & ends[1])}
    for side, (ids, parts) in enumerate(((a, bytes_a), (b, bytes_b))):
        at = 0
        for token, part in zip(ids, parts, strict=True):
            at += len(part)
            groups[min(e for e in groups if e >= at)][side].append(token)
    return list(groups.values())


def wanted(texts):
    every = [groups_of(t) for t in texts]
    links = [[(p, q) for g in gs for p in g[0] for q in g[1]] for gs in every]
    count = Counter(pair for found in links for pair in set(found))
    best = {}
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for gs, found in zip(every, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in gs)
        out.append((sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(found),
                    sum(count[pair] == best[pair[0]] for pair in found),
                    sum(count[pair] for pair in found),
                    hashlib.sha256(text.encode()).hexdigest() if gs else "", text))
    return out


TEXTS = [None, "", " ", "  two  blanks ", "a", "plain words, and more of them", "plain words",
         "plain words", "plain words", "<|endoftext|> <s> <0x41> </s>", "▁ is a blank here",
         "éß 漢字 \U0001d518 ﬁ naïve", "tab\tline\nend\r\n", "\u0000 null", "ﬁ   ½ ｆｕｌｌ",
         "a" * 3000, "the cat " * 2000, "x-y_z" * 50, "\n\n\n", "é"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("run_pairs", [1, 40, 2_000_000])
def test_equals_a_walk(spark, run_pairs):
    prepared(spark)
    docs = spark.createDataFrame([(n, t, 1, 1, "x") for n, t in enumerate(TEXTS)],
                                 "doc_id bigint, text string, pair int, run int, key string")
    got = {r.doc_id: r for r in alignment.measures(docs, *PATHS, run_pairs=run_pairs).collect()}
    for n, want in enumerate(wanted(TEXTS)):
        assert tuple(got[n][c] for c in COLUMNS) == want, TEXTS[n]


def test_null_ids_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "some text"), (1, "some text"), (1, "some text"),
                                  (None, None)], "doc_id bigint, text string")
    got = alignment.measures(docs, *PATHS).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "None", "None"]
    assert sorted(r.count_sum for r in got) == [0, 6, 6, 6]
    assert alignment.measures(docs.limit(0), *PATHS).count() == 0


def test_groups_of_many_links_are_counted_by_distinct_tokens(monkeypatch):
    draw = np.random.default_rng(3)
    n = 60
    found = alignment.Aligned(
        draw.integers(0, 9, n), draw.integers(0, 7, n), np.zeros(n, int), np.zeros(n, int),
        np.repeat(np.arange(4), n // 4), np.repeat(np.arange(4), n // 4), np.zeros(4, int))
    want = Counter((int(a) * 10 + int(b)) for g in range(4)
                   for a in found.a[found.group_a == g] for b in found.b[found.group_b == g])
    for limit in (1 << 20, 100, 1):
        monkeypatch.setattr(alignment, "BATCH_LINKS", limit)
        _, pair, links = alignment.pairs(found, 10)
        assert dict(zip(pair.tolist(), links.tolist(), strict=True)) == want


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_alignment"](spark, "/root/testdata/sf0.001").collect()}
    for row, want in zip(rows, wanted([r.text for r in rows]), strict=True):
        assert tuple(got[row.doc_id][c] for c in COLUMNS[:-1]) == want[:-1]


def test_no_step_of_an_alignment_is_a_call_per_token():
    """Python calls grow with the texts only; one per token took a third of the CPU time."""
    import cProfile
    both = alignment.tokenizers(public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["some words of a text, " * 500, "", "a퟿▁b <s>", "more words " * 900]

    def calls(texts):
        profile = cProfile.Profile()
        found = profile.runcall(alignment.align, both, texts)
        return found, sum(entry.callcount for entry in profile.getstats())
    found, n = calls(texts)
    assert len(found.a) > 3000 and n < 1000
    for k, text in enumerate(texts):  # as each text alone, with the same groups
        alone = alignment.align(both, [text])
        some_a, some_b = found.text_a == k, found.text_b == k
        assert found.a[some_a].tolist() == alone.a.tolist()
        assert found.b[some_b].tolist() == alone.b.tolist()
        first = int(found.group_a[some_a].min()) if len(alone.a) else 0
        assert (found.group_b[some_b] - first).tolist() == alone.group_b.tolist()
