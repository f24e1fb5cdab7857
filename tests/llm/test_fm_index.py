import random

import numpy as np
import pytest

from tidemark.llm.fm_index import FMIndex, WaveletMatrix


def test_ranks():
    draw = np.random.default_rng(1)
    for largest in (0, 1, 2, 5, 300):
        numbers = draw.integers(0, largest + 1, 777)
        matrix = WaveletMatrix(numbers, largest)
        symbols, at = draw.integers(0, largest + 1, 200), np.r_[0, 777, draw.integers(0, 778, 198)]
        assert matrix.rank(symbols, at).tolist() == [int((numbers[:k] == s).sum()) for s, k in zip(symbols, at)]


@pytest.mark.parametrize("most", [1, 5, 50])
def test_matching_statistics(most):
    for seed in range(40):
        draw = random.Random(seed)
        words = draw.choice([1, 2, 4, 40])
        text = [draw.randrange(words) for _ in range(draw.randint(1, 300))]
        texts = [[draw.randrange(words + 1) for _ in range(draw.randint(0, 60))] for _ in range(5)] + [text[10:90], text]
        index = FMIndex(np.array(text), most)
        assert index.suffixes.tolist() == sorted(range(len(text) + 1), key=lambda i: text[i:])
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        length, low, high = index.matching_statistics(np.array(sum(texts, [])), starts, ends)
        for k, t in enumerate(texts):
            for i in range(0, len(t), 1 + len(t) // 25):
                runs = [next((n for n in range(min(most, len(t) - i)) if j + n >= len(text) or text[j + n] != t[i + n]), min(most, len(t) - i)) for j in range(len(text))]
                at = starts[k] + i
                assert length[at] == max(runs)
                if length[at]:
                    assert sorted(index.suffixes[low[at] : high[at]]) == [j for j, n in enumerate(runs) if n >= length[at]]
