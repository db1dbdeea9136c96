"""STR-1: first usable snapshot per question on a stream of page snapshots.

``emit="deadline"`` is a streaming aggregation: rows are grouped by question and the time its answer is due, the earliest usable snapshot
(by ``ts``, then ``event_id``) is kept as the group's only state, and the watermark on the due time emits and forgets a group. Snapshots
are reduced in the JVM, on the map side first, so a question with very many of them is one row per task and batch. It
equals the batch twin (``operators.answers.first_meaningful``) when snapshots arrive out of order, as long as they are no later
than the watermark delay.

``emit="first"`` answers at once, which an aggregation cannot: keyed state in Python, with an event-time timer at the deadline.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vendorscope import fixed
from vendorscope.functions.text import is_meaningful

OUT_SCHEMA = "question_id long, status string, ts timestamp_ntz, event_id long, answer string"
STATE_SCHEMA = "asked_us long, best_us long, best_event long, best_answer string, done boolean"


def _row(qid, status, ts_us=None, ev=None, ans=None) -> pd.DataFrame:
    ts = pd.NaT if ts_us is None else pd.Timestamp(int(ts_us), unit="us")
    return pd.DataFrame({"question_id": [qid], "status": [status], "ts": [ts],
                         "event_id": [None if ev is None else int(ev)], "answer": [ans]})


def _decide(deadline_us: int):
    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (qid,) = key
        if state.hasTimedOut:
            done = state.get[4]
            state.remove()
            if done:
                return
            yield _row(qid, "no_response")
            return
        asked, best_us, best_ev, best_ans, done = state.get if state.exists else (None, None, None, None, False)
        if done:  # answered early: later snapshots change nothing; keep the tombstone until the deadline
            for _ in batches:
                pass
            wm = state.getCurrentWatermarkMs()
            state.setTimeoutTimestamp(max((asked + deadline_us) // 1000 + 1, (wm or 0) + 1))
            return
        for pdf in batches:
            ts_us = pdf["ts"].astype("datetime64[us]").astype("int64")
            asked_us = pdf["asked_ts"].astype("datetime64[us]").astype("int64")
            asked = int(asked_us.min()) if asked is None else min(asked, int(asked_us.min()))
            ok = (pdf["usable"].astype(bool) & (ts_us <= asked_us + deadline_us)).to_numpy()
            if ok.any():
                t, ev = ts_us.to_numpy()[ok], pdf["event_id"].to_numpy()[ok]
                i = np.lexsort((ev, t))[0]  # earliest (ts, event_id) of this batch, vectorised
                if best_us is None or (int(t[i]), int(ev[i])) < (int(best_us), int(best_ev)):
                    best_us, best_ev, best_ans = int(t[i]), int(ev[i]), pdf["answer"].to_numpy()[ok][i]
        if best_us is not None:
            done = True
            yield _row(qid, "success", best_us, best_ev, best_ans)
        state.update((asked, best_us, best_ev, best_ans, done))
        wm = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max((asked + deadline_us) // 1000 + 1, (wm or 0) + 1))

    return fn


def stream_first_meaningful(snapshots: DataFrame, deadline_s: int = fixed.ANSWER_DEADLINE_S,
                            watermark: str = "1 hour", key: str = "question_id",
                            emit: str = "deadline") -> DataFrame:
    """Streaming snapshots -> one decided row per question.

    ``snapshots``: key, event_id, ts (timestamp_ntz), asked_ts (one per question), answer.

    ``emit="deadline"`` decides when the watermark passes the deadline (exact
    under bounded disorder). ``emit="first"`` answers as soon as a usable
    snapshot arrives, like polling a live page: equal to the batch result
    when snapshots arrive in event order, with lower latency.
    """
    src = (snapshots.withColumn("ts", F.col("ts").cast("timestamp"))
           .withColumn("asked_ts", F.col("asked_ts").cast("timestamp"))
           .withColumn("usable", is_meaningful(F.col("answer"))))
    if emit == "first":
        return src.withWatermark("ts", watermark).groupBy(key).applyInPandasWithState(
            _decide(int(deadline_s) * 1_000_000), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    src = src.withColumn("due", F.col("asked_ts") + F.expr(f"INTERVAL {int(deadline_s)} SECONDS")).withWatermark("due", watermark)
    usable = F.col("usable") & (F.col("ts") <= F.col("due"))
    first = F.min_by(F.struct("ts", "event_id", "answer"), F.when(usable, F.struct("ts", "event_id")))
    out = src.groupBy(key, "due").agg(first.alias("_w"))
    return out.select(F.col(key), F.when(F.col("_w").isNull(), "no_response").otherwise("success").alias("status"),
                      F.col("_w.ts").cast("timestamp_ntz").alias("ts"), "_w.event_id", "_w.answer")
