"""The registered query looks at two previous words, and n-grams keep whole 64-bit names."""

import numpy as np

from tallyloom.llm.katz import Settings, katz
from tallyloom.llm.packing import unpack
from tallyloom.llm.queries import QUERIES

from .test_katz import agrees, random_rows


def test_query_equals_plain_version_of_order_three(spark, sf_dir, documents):
    agrees(list(documents.items()), QUERIES["op1_katz_score"](spark, sf_dir), 3)


def test_names_have_64_bits(spark, docs):
    counts = katz(docs(*random_rows()), Settings(order=3)).counts.where("level > 1").select("keys").collect()
    keys = np.concatenate([unpack(r["keys"], rising=True) for r in counts])
    assert len(keys) > 100 and (keys & np.uint64(0xFF)).any()
