"""The last stage of the n-gram Jaccard join: links between groups within clusters, as few as join them."""

import numpy as np
import pytest
from test_llm_operators import ODD_ROWS, changed, jaccard_by_hand, prose

from labwatch.llm import jaccard
from labwatch.llm.jaccard import jaccard_components


def chain(seed, length, step, words=120):
    """Texts of which each is near the next only."""
    text, out = prose(seed, words), []
    for n in range(length):
        out.append(text)
        text = changed(text, *[(n * step + k * 7) % words for k in range(step)])
    return out


@pytest.mark.parametrize("block_rows", [4096, 9])
def test_chains_and_groups_near_the_threshold(spark, documents, monkeypatch, block_rows):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(jaccard, "KEY_ROWS", block_rows)
    written, write = {}, jaccard.stored

    def counted(df, label):
        out = write(df, label)
        written.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    random = np.random.default_rng(9)
    texts = [t for s in range(4) for t in chain(s, 25, 2 + s)]
    # A group around a text that is not there: some reach each other, most are just below.
    for base in range(3):
        texts += [changed(prose(50 + base, 200), *random.integers(0, 200, 3 + base).tolist()) for _ in range(40)]
    texts += [prose(70, 9), prose(70, 9) + " one", prose(70, 9) + " one two", "a b c d e f", "a b c d e g"]
    rows = [*enumerate(texts), *[(900 + i, t) for i, t in enumerate(texts[:30])], *[(2000 + n, t) for n, (_, t) in enumerate(ODD_ROWS)]]
    got = jaccard_components(documents(*rows), 5, 80, 100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == jaccard_by_hand(rows, 5, 80, 100)
    members = written["members"][0] if "members" in written else 0
    assert members and written["jaccard-links"][-1] < members * -(-members // block_rows)
