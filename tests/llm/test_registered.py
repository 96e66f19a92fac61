"""Every registered query of the subpackage has a DuckDB twin or tests against brute force of its own."""
import pathlib

import __spark_entry__ as E
from estatelens.llm import queries

BRUTE_FORCE = {"op1_sharding": "test_sharding", "op2_nearest_neighbours": "ann.nearest", "op3_pii": "pii", "op4_secrets": "secrets", "op5_quality_rules": "quality.verdicts",
               "op7_simhash": "simhash.near_duplicates", "op8_packing": "packing.packed", "op9_lm_scoring": "lm.scored", "op10_mixing": "mixing.", "op13_conversation_repair": "repair.repaired",
               "pipeline": "corpus_pipeline.run"}


def test_every_query_has_a_twin_or_a_test():
    source = "".join(p.read_text() for p in pathlib.Path(__file__).parent.glob("test_*.py") if p.name != "test_registered.py")
    assert set(queries.REGISTRY) <= set(E.queries())
    for name in queries.REGISTRY:
        assert name in queries.ORACLES or BRUTE_FORCE[name] in source, name
