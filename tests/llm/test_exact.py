import hashlib
import re
from collections import defaultdict

import pytest

from shelfrank.llm import exact
from tests.llm.frames import OWN, frame, odd_rows


def brute(rows):
    groups = defaultdict(list)
    for place, (doc_id, text, *_) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]+", "", text or "")
        groups[plain].append((-len(text or ""), doc_id is None, doc_id, place))
    out = []
    for plain, own in groups.items():
        own.sort(key=lambda r: (r[0], r[1], r[2] or 0, r[3]))
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(r[2], own[0][2], len(own), k == 0, sha) for k, r in enumerate(own)]
    return sorted(map(str, out))


@pytest.mark.parametrize("support", [0.0005, 0.3])
def test_groups_match_brute_force(spark, support):
    rows = odd_rows() + [(100 + i, "copy  of a text" + " " * (i % 3)) for i in range(40)]
    got = exact.exact_groups(frame(spark, rows).coalesce(1), support).drop("text_key").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_empty_table_and_kept_rows(spark):
    rows = odd_rows()
    assert exact.exact_groups(frame(spark, [])).count() == 0
    kept = exact.drop_copies(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", "", r.text or "") for r in kept.select(*OWN).collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", "", t or "") for _, t, *_ in rows})
