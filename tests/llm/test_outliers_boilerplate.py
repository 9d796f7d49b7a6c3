"""Texts of duplicate lines or repeated words alone, among ordinary ones."""

import random

from tallyloom.llm.outliers import quality_rules


def test_duplicate_lines_and_repeated_words_reject_alone(spark, docs):
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n)]

    def lines(n):
        return [" ".join(words(rng.randrange(6, 12))) for _ in range(n)]

    rows = [(i, "\n".join(lines(rng.randrange(8, 40)))) for i in range(300)]
    for k, repeats in enumerate((2, 3, 5, 8)):
        # one word as line: the windows of three words around it differ
        menu = "\n".join(x + "\nhome" * 2 + "".join(f"\n{w}\nhome" for w in words(1) * (repeats - 2)) for x in lines(20))
        rows.append((1000 + k, menu))
    for k, share in enumerate((0.3, 0.35, 0.4, 0.45)):
        phrase = words(10)
        n = 200
        parts = [words(1) + phrase for _ in range(int(share * n / 10))]
        flat = [w for p in parts for w in p] + words(n - 11 * len(parts))
        at = [" ".join(flat[i : i + 9]) for i in range(0, n, 9)]
        rows.append((2000 + k, "\n".join(at)))
    got = {r.doc_id: r for r in quality_rules(docs(*rows)).collect()}
    judged = [r for i, r in got.items() if i >= 1000 and not r.base_failed]
    assert len(judged) >= 6
    assert not any(r.kept for r in judged)
    assert sum(got[i].kept for i in range(300)) >= 0.98 * 300
