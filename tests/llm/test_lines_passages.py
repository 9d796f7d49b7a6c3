"""Repeated passages whose ends are no chunks of their own."""

import random

from tallyloom.llm.lines import remove_repeated
from tallyloom.llm.queries import QUERIES


def test_whole_passages_go_wherever_they_stand(spark, docs):
    rng = random.Random(4)

    def own(n):
        return [f"own {rng.random()}" for _ in range(n)]

    rows, left = [], {}
    for k in range(60):
        size = (3, 4, 5, 10)[k % 4]
        passage = [f"passage {k} {j} {rng.random()}" for j in range(size)]
        rows.append((2 * k, "\n".join(own(rng.randrange(1, 9)) + passage + own(rng.randrange(1, 9)))))
        head, tail = own(rng.randrange(1, 9)), own(rng.randrange(1, 9))
        rows.append((2 * k + 1, "\n".join(head + passage + tail)))
        left[2 * k + 1] = ("\n".join(head + tail), size)
    single = "one line that repeats alone"
    rows += [(900, f"{single}\nfirst"), (901, f"second\n{single}")]
    got = {r.doc_id: (r.text, r.n_removed) for r in remove_repeated(docs(*rows)).collect()}
    for doc, text in rows:
        assert got[doc] == left.get(doc, (text, 0))


def test_query_leaves_no_three_lines_twice(spark, sf_dir, documents):
    """Of any three lines with a word that stand before, two neighbours at least go."""
    got = {r.doc_id: r.text for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect()}
    seen, repeated = set(), 0
    for doc, text in sorted(documents.items()):
        lines = (text or "").split("\n")
        left = (got[doc] or "").split("\n")
        worded = [i for i, x in enumerate(lines) if x.encode().strip()]
        stays, at = set(), len(left) - 1
        for i in range(len(lines) - 1, -1, -1):
            if at >= 0 and lines[i] == left[at]:
                stays.add(i)
                at -= 1
        assert at < 0 or left == [""]
        if len(set(lines)) < len(lines):
            continue
        for a, b, c in zip(worded, worded[1:], worded[2:]):
            part = tuple(lines[a : c + 1])
            if part in seen:
                repeated += 1
                assert len({a, b, c} & stays) < 2
            seen.add(part)
    assert repeated > 100
