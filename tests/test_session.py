"""The limit on fused methods."""

from zonescope.plans.queries import Models
from zonescope.session import COMPILED_BYTECODE, HUGE_METHOD_LIMIT


def test_long_stages_stay_compiled_unless_a_limit_is_set(spark):
    other = spark.newSession()
    Models(other, "/nowhere")
    assert other.conf.get(HUGE_METHOD_LIMIT) == COMPILED_BYTECODE
    other.conf.set(HUGE_METHOD_LIMIT, "20000")
    Models(other, "/nowhere")
    assert other.conf.get(HUGE_METHOD_LIMIT) == "20000"
