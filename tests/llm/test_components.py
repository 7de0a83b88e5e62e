"""Components under edges that come one after the other."""

import random

from casemart.llm.components import components, merged_components
from casemart.llm.storage import Scratch


def smallest(edges):
    label = {node: node for edge in edges for node in edge}
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    return label


def test_edges_added_later_give_the_components_of_all(spark, monkeypatch):
    draw = random.Random(5)
    first, second = ([tuple(draw.sample(range(60), 2)) for _ in range(count)] for count in (25, 20))
    scratch, stored = Scratch(spark, "test"), []
    frame = lambda edges: spark.createDataFrame(edges, "u long, v long")
    label = components(frame(first), scratch, "a")
    store = Scratch.store
    monkeypatch.setattr(Scratch, "store", lambda self, df, table: stored.append((table, store(self, df, table))) or stored[-1][1])
    for name, more in (("b", second), ("c", [(7, 7)])):
        label = merged_components(label, frame(more), scratch, name)
        expected = smallest(first + second)
        assert {row.node: row.component for row in label.collect()} == expected and label.count() == len(expected)
    # known links aren't contracted again
    assert [table for table, _ in stored if table.startswith("c")] == ["c-0", "c-all"]
