import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import edge_rows, ids_and
from tidemark.llm import alignment

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_characters():
    """The byte that each character of a byte-level token stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def brute(rows):
    """Whole texts, every pair of tokens compared within a window of byte ranges."""
    a_of = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    shown = byte_characters()
    out, held, links = [], Counter(), []
    for i, t in rows:
        a = a_of.encode(" " + (t or ""), add_special_tokens=False)
        a_raw = [bytes(shown[c] for c in token) for token in a.tokens]
        a_ids = a.ids
        b = b_of.encode(t or "")
        b_raw = [bytes([b_of.id_to_piece(x)[3:5] and int(b_of.id_to_piece(x)[3:5], 16)]) if b_of.is_byte(x) else b_of.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = (" " + (t or "")).encode()
        if not t or b"".join(a_raw) != want or b"".join(b_raw) != want:
            out.append((i, 0, 0, 0, ""))
            links.append([])
            continue
        spans = []
        for raw in (a_raw, b_raw):
            at, found = 0, []
            for x in raw:
                found.append((at, at + len(x)))
                at += len(x)
            spans.append(found)
        cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        halves = []
        for ids, found in zip((a_ids, b), spans):
            lists = [[]]
            for x, (_, end) in zip(ids, found):
                lists[-1].append(str(x))
                if end in cuts:
                    lists.append([])
            halves.append(lists[:-1])
        groups = list(zip(*halves))
        mine, j = [], 0
        for x, (s, e) in zip(a_ids, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                mine.append((x, b[k]))
                k += 1
        links.append(mine)
        held.update(set(mine))
        printed = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        out.append((i, len(a_ids), len(b), len(cuts), hashlib.sha256(printed.encode()).hexdigest()))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return sorted(
        [(i, na, nb, ng, len(m), sum(held[p] == best[p[0]] for p in m), sum(held[p] for p in m), sha) for (i, na, nb, ng, sha), m in zip(out, links)], key=repr
    )


TEXTS = [
    "plain words of a text", " leading", "trailing ", "two  spaces   three", "tab\tand\n new line \n", "\n", " ", "  ", "a\n b\n  c", "<|endoftext|> <s></s><unk>",
    "▁ is read as a space", "don't it's we'll", "naïve café 漢字 🎉🎉 é", " no break wide  ", "x" * 500, "0x1F 123456789 3.14", "\x00\x1c \x1f", "\r\n \r\n", "ﬁ Ⅷ Å",
    "a   b  c", "🎉 " * 40, "!!! ... ??? --- ;|,",
]


@pytest.mark.parametrize("block", [1, 60, alignment.BLOCK])
def test_equals_whole_texts(spark, block):
    rows = [(k, t) for k, t in enumerate(TEXTS + TEXTS[:7])]
    got = alignment.link_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), block=block)
    assert ids_and(got, *COLUMNS) == brute(rows)


def test_documents(documents):
    assert ids_and(alignment.link_report(documents), *COLUMNS) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_awkward_rows(edge, no_docs):
    assert ids_and(alignment.link_report(edge), *COLUMNS) == brute([(i, t) for i, t, *_ in edge_rows()])
    assert alignment.link_report(no_docs).count() == 0 and alignment.alignments(no_docs).count() == 0


def test_forgetting_changes_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(alignment, "_PIECES", 50)
    aligner = alignment.Aligner()
    texts = [r.text for r in documents.limit(40).collect()]
    first = [[aligner.groups[i] for i in ids] for ids in aligner.look_up(texts)]
    for text, pieces in zip(texts, first):
        aligner.trim()
        assert [aligner.groups[i] for i in aligner.look_up([text])[0]] == pieces


def test_groups(spark):
    rows = [(k, t) for k, t in enumerate([*TEXTS, None, ""])]
    got = {r.doc_id: r.groups for r in alignment.alignments(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = {i: sha for i, *_, sha in brute(rows)}
    for i, groups in got.items():
        printed = ";".join(f"{','.join(map(str, g.a))}|{','.join(map(str, g.b))}" for g in groups)
        assert (hashlib.sha256(printed.encode()).hexdigest() if groups else "") == want[i]


def test_links_of_a_group():
    assert alignment.links([2, 3, 1], [3, 3]) == [(0, 0), (1, 0), (1, 1), (2, 1)]
    assert alignment.links([5], [1, 1, 3]) == [(0, 0), (0, 1), (0, 2)]
    assert alignment.align([7, 8, 9], [1, 2, 3], [4, 5], [3, 3]) == [(0, 2, 0, 1), (2, 3, 1, 2)]


def test_pieces_learned_together_are_told_apart_at_once(documents, monkeypatch):
    texts = [r.text for r in documents.limit(60).collect()] + TEXTS
    monkeypatch.setattr(alignment, "_JOINED", 500)
    aligner, alone = alignment.Aligner(), alignment.Aligner()
    pieces = list(dict.fromkeys(p for t in texts for p in aligner.pieces(t)))
    for piece in pieces:
        alone._learn_alone(piece)
    one_by_one = []
    align = alignment.align
    monkeypatch.setattr(alignment, "align", lambda *a: one_by_one.append(a) or align(*a))
    aligner.learn(pieces)
    assert len(one_by_one) < len(pieces) / 4
    for piece in pieces:
        i, j = aligner.known[piece], alone.known[piece]
        assert aligner.groups[i] == alone.groups[j]
        assert aligner.numbers[4 * i : 4 * i + 4] == alone.numbers[4 * j : 4 * j + 4]
        assert aligner.pairs[aligner.ends[i] : aligner.ends[i + 1]] == alone.pairs[alone.ends[j] : alone.ends[j + 1]]
