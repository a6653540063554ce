"""Flows resume from stored steps and take steps from the user."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from exonloom.plans import flows
from exonloom.plans.steps import Steps
from exonloom.scale import work_dir


@pytest.fixture
def folder(spark):
    return f"{work_dir(spark)}/steps-{uuid.uuid4().hex}"


def test_lost_step_is_made_again_and_others_are_read(spark, folder):
    made = []

    def step(steps, name, rows):
        return steps(name, lambda: made.append(name) or spark.createDataFrame(rows, "n long"))

    def flow(steps):
        a = step(steps, "a", [(1,), (2,)])
        b = steps("b", lambda: made.append("b") or a.select(F.sum("n").alias("n")))
        steps.finish()
        return b.first()["n"]

    assert flow(Steps(spark, folder)) == 3 and made == ["a", "b"]
    assert flow(Steps(spark, folder)) == 3 and made == ["a", "b"]
    os.remove(f"{folder}/b/_SUCCESS")  # as if the write had broken off
    assert flow(Steps(spark, folder)) == 3 and made == ["a", "b", "b"]
    other = Steps(spark, folder + "2", given={"a": spark.createDataFrame([(5,)], "n long")})
    assert flow(other) == 5 and made == ["a", "b", "b", "b"] and not os.path.exists(f"{folder}2/a")
    other.drop()
    assert not other.stored("b")
    with pytest.raises(ValueError, match="no such steps: x"):
        flow(Steps(spark, given={"x": spark.createDataFrame([(5,)], "n long")}))
    with pytest.raises(ValueError, match="twice"):
        twice = Steps(spark)
        step(twice, "a", [(1,)]), step(twice, "a", [(1,)])


def test_annotate_with_replaced_annotations(spark, folder):
    src = spark.createDataFrame([("G_1-T1", "note", "SEED"), ("G_2-T1", "product", "kinase")], "id string, ref_db string, value string")
    plain = flows.annotate([src], ["G_"])
    kept = flows.annotate([src], ["G_"], steps=Steps(spark, folder))
    for name in ("annotations", "channels", "headers"):
        assert sorted(map(str, kept[name].collect())) == sorted(map(str, plain[name].collect()))
        assert os.path.exists(f"{folder}/{name}/_SUCCESS")
    mine = plain["annotations"].where("id = 'G_2-T1'")
    out = flows.annotate([src], ["G_"], steps=Steps(spark, given={"annotations": mine}))
    assert sorted(map(str, out["channels"].collect())) == sorted(str(r) for r in plain["channels"].collect() if r["id"] == "G_2-T1")
