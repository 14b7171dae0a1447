from pyspark.sql import functions as F

from stayline.llm import similar_sets as sim
from stayline.llm.common import Staged


def test_a_row_that_repeats_is_compared_once(spark, docs, monkeypatch):
    monkeypatch.setattr(sim, "BLOCK", 7)
    compare, most = sim._compare, []

    def seen(blocks, percent):
        most.append(blocks.groupBy("cluster", "one", "two").count().agg(F.max("count")).first()[0])
        return compare(blocks, percent)

    monkeypatch.setattr(sim, "_compare", seen)
    words = [f"w{i}" for i in range(40)]
    rows = [(5, " ".join(words))] * 200 + [(None, " ".join(words))] * 100 + [(3, " ".join([*words[:-1], "x"])), (9, "another text of few words")]
    found = sim.similar(docs(*rows), Staged(spark, "test")).collect()
    assert most == [2]
    assert len(found) == 302 and {(r.doc_id, r.component_id) for r in found} == {(5, 3), (None, 3), (3, 3), (9, 9)}
