"""Physical-plan checks: what each query asks of the engine at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from postlens.plans import catalog
from conftest import SF_SMALL


def _explain(df, mode: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _plan(df) -> str:
    return _explain(df, "formatted")


def _optimized(df) -> str:
    return _explain(df, "extended")


BATCH = sorted(n for n in catalog.REGISTRY if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["all_columns", "join_three_way_full_outer", "interaction_totals",
                                  "media_counts_by_user", "posts_by_time", "interval_join_full_outer"])
def test_full_outer_joins_are_decomposed(spark, name):
    """No full outer join reaches the planner: left-outer + anti joins can be
    split by AQE when a key is hot, a full outer sort-merge join cannot."""
    assert "FullOuter" not in _optimized(E.queries()[name](spark, SF_SMALL))


def test_text_scan_reads_one_column(spark):
    plan = _plan(E.queries()["word_frequency"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_top_words_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["top_words"](spark, SF_SMALL))


def test_interval_join_is_an_equi_join_on_key_and_bucket(spark):
    plan = _plan(E.queries()["interval_join_left_nullsafe"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan or "ShuffledHashJoin" in plan


def test_stop_words_become_a_hash_set(spark):
    assert "INSET" in _optimized(E.queries()["word_frequency"](spark, SF_SMALL)).upper()


def test_equality_filter_reaches_the_scan_through_the_outer_join(spark):
    plan = _plan(E.queries()["filter_equals"](spark, SF_SMALL))
    assert "EqualTo(c_name,Customer#000000007)" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["interaction_totals"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "text:string" not in plan                                 # no text read for sums
