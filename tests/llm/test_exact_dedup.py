import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm.common import ASCII_LOWER
from churnlens.llm.exact_dedup import exact_dedup, md5_128


def lowered(t):
    return (t or "").encode().translate(ASCII_LOWER)


# the second digest sends every text of a length to one hash: all groups collide
@pytest.mark.parametrize("digest", [md5_128, lambda t: F.unhex(F.md5((F.length(t) % 7).cast("string")))])
@pytest.mark.parametrize("stays", ["largest", "smallest"])
def test_groups(docs, digest, stays):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    got = exact_dedup(docs, stays=stays, digest=digest).collect()
    assert len(got) == len(rows)
    pick = max if stays == "largest" else min
    want = sorted((str(i), str(pick((x for x in groups[lowered(t)] if x is not None), default=None)),
                   len(groups[lowered(t)]), hashlib.sha256(lowered(t)).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(groups)


def test_empty(empty):
    assert exact_dedup(empty).count() == 0


def test_native(docs):
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
