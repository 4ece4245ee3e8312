from datetime import timedelta, timezone

from tallywind.session import new_folder
from tallywind.streaming.state import state_operators, watermark_of, window_state
from tests.test_streaming import T0, deliver, posts


def held(spark, checkpoint, **options):
    found = window_state(spark, checkpoint, **options).drop("window_end").collect()
    return {(start, topic): tuple(counts) for start, topic, *counts in found}


def test_state_after_each_run(spark):
    root = new_folder(spark, "state")
    checkpoint = f"{root}/checkpoint"
    deliver(spark, root, posts(spark, (0, "a", 0), (0, None, 1), (6, "a", 2)))
    five = T0 + timedelta(minutes=5)
    assert held(spark, checkpoint) == {
        (T0, "a"): (1, 0, 0), (T0, None): (0, 1, 0), (five, "a"): (0, 0, 1)
    }
    deliver(spark, root, posts(spark, (7, "a", 2), (21, "b", 0)))
    # 21 minutes less 15: the first window has ended, the second has not.
    six = (T0 + timedelta(minutes=6)).replace(tzinfo=timezone.utc)
    assert watermark_of(spark, checkpoint) == six
    twenty = T0 + timedelta(minutes=20)
    assert held(spark, checkpoint) == {(five, "a"): (0, 0, 2), (twenty, "b"): (1, 0, 0)}
    operators = state_operators(spark, checkpoint).collect()
    assert len(operators) == 1 and operators[0]["operatorName"] == "stateStoreSave"
    assert len(held(spark, checkpoint, batch=0)) == 3
