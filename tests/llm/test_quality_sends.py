import pytest
from test_operators import SETS, same, table

from tidegauge.llm import quality


@pytest.mark.parametrize("name", SETS)
def test_quality_sends_each_text_to_its_task_once(spark, name):
    docs = table(spark, SETS[name])
    counted = quality.with_counts(docs, docs.columns)
    same(counted.select(*docs.columns), map(tuple, docs.collect()))
    read = counted._jdf.queryExecution().optimizedPlan().toString()
    sent = next(x for x in read.split("\n")[read.split("\n").index(next(x for x in read.split("\n") if "MapInArrow" in x)) + 1 :] if "Project" in x)
    assert sent.count("text") == 1
