"""Echo and repetition rules as expressions; the first rule that holds gives the reason."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text as tx


def with_echo_reason(df: DataFrame, user: str, reply: str, out: str = "reason", variant: str = "generator") -> DataFrame:
    """df with the reason why `reply` echoes `user`, or null. The audit variant goes on where one side has stop words only,
    and does not count `basically` among the words of agreement."""
    if variant not in ("generator", "audit"):
        raise ValueError(f"unknown variant {variant}")
    un, rn, uc, rc = (F.col(f"_{out}_{x}") for x in ("un", "rn", "uc", "rc"))
    said, got = (F.coalesce(F.col(c), F.lit("")) for c in (user, reply))
    staged = tx.computed(df, {f"_{out}_un": tx.words(said), f"_{out}_rn": tx.words(got), f"_{out}_uc": tx.echo_words(said), f"_{out}_rc": tx.echo_words(got)})
    lead = F.coalesce(F.try_element_at(rn, F.lit(1)).isin(tx.REFLECTIVE_LEADS), F.lit(False))
    agreeing = F.coalesce(F.try_element_at(rn, F.lit(1)).isin(tx.AGREEMENT_LEADS + (["basically"] if variant == "generator" else [])), F.lit(False))
    shared = F.size(F.array_intersect(uc, rc))
    cu, cr = shared / F.size(F.array_distinct(uc)), shared / F.size(F.array_distinct(rc))
    reason = F.when((F.size(un) == 0) | (F.size(rn) == 0), None).when((F.size(un) <= 3) & tx.starts_with(rn, un), "short_exact_echo")
    if variant == "generator":
        reason = reason.when((F.size(uc) == 0) | (F.size(rc) == 0), None)
    reason = (
        reason.when(tx.share_run(uc, rc, 4), "long_common_phrase").when(tx.share_run(un, rn, 5), "exact_5gram").when(tx.share_run(un, rn, 4), "exact_4gram")
        .when(lead & tx.share_run(uc, rc, 3), "reflective_exact_3gram").when(shared == 0, None).when(lead & (shared >= 5) & (cr >= 0.60), "reflective_high_overlap")
        .when(agreeing & (shared >= 3) & (cr >= 0.45), "agreement_rephrase").when((shared >= 5) & (cu >= 0.55) & (cr >= 0.45), "high_overlap")
    )
    return tx.computed(staged, {out: reason}).drop(*(f"_{out}_{x}" for x in ("un", "rn", "uc", "rc")))


def reply_problem(reply: Column, reason: Column, has_user: Column) -> Column:
    """Why a reply is invalid: empty, an end mark, or an echo of the latest user text if there is one."""
    return F.when(tx.strip(F.coalesce(reply, F.lit(""))) == "", "empty_reply").when(tx.is_end(reply), "end_reply").when(has_user, reason)


def too_echoed(u: Column, a: Column, us: Column, as_: Column) -> Column:
    """Of tokenizer B's words and content sets of a user text and a reply: whether the reply repeats the text."""
    shared = F.size(F.array_intersect(us, as_))
    return F.when((F.size(u) == 0) | (F.size(a) == 0), False).when((F.size(u) <= 3) & tx.starts_with(a, u), True).when(tx.share_run(u, a, 5), True).when((F.size(us) < 4) | (F.size(as_) < 4), False).otherwise((shared >= 5) & (shared / F.size(as_) >= 0.60))


def reply_repeats(w: Column, s: Column, earlier_w: Column, earlier_s: Column) -> Column:
    """Whether an assistant message repeats an earlier one."""
    least = F.greatest(F.lit(1), F.least(F.size(s), F.size(earlier_s)))
    return ((F.size(s) >= 4) & (F.size(F.array_intersect(s, earlier_s)) / least >= 0.60)) | ((F.size(w) >= 6) & tx.share_run(w, earlier_w, 5)) | ((F.size(w) >= 4) & (w == earlier_w))


def user_repeats(w: Column, s: Column, earlier_w: Column) -> Column:
    """Whether a user message repeats an earlier one of four words or more."""
    run = F.greatest(F.lit(9), F.ceil(F.least(F.size(w), F.size(earlier_w)) * 0.9)).cast("int")
    return (F.size(w) >= 4) & (F.size(earlier_w) >= 4) & ((w == earlier_w) | ((F.size(s) >= 4) & tx.share_run(w, earlier_w, run)))


BLOCK = 4_096  # items of a batch that one task looks through


def _best(index: pd.DataFrame, probes: pd.DataFrame) -> list[int]:
    """Of each probe the most tokens that one item of the index, not its own, has in common with it."""
    listed: dict[str, list[int]] = {}
    for k, tokens in enumerate(index["tokens"]):
        for t in tokens:
            listed.setdefault(t, []).append(k)
    lists = {t: np.array(v) for t, v in listed.items()}
    own: dict = {}
    for k, i in enumerate(index["item_id"]):
        own.setdefault(i, []).append(k)
    out = []
    for i, tokens in zip(probes["item_id"], probes["tokens"], strict=True):
        hits = [lists[t] for t in tokens if t in lists]
        n = np.bincount(np.concatenate(hits), minlength=len(index)) if hits else np.zeros(1, np.int64)
        if hits and i in own:
            n[own[i]] = 0
        out.append(int(n.max()))
    return out


def misassigned(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """items (batch_id, item_id, user, topic, reply) with own, best_other and suspicious: whether the reply fits another item
    of its batch better than its own. item_id is unique in a batch.

    A batch is cut into blocks of about `block` items, which are indexed by their tokens; each item's reply is looked up in all blocks
    of its batch, and the best of all counts. No pair is made, however common a token is; a batch of n items has n * n / block
    look-ups, dealt over its blocks. A batch of up to `block` items, as batches are, is one group.
    """
    ground = F.when(F.size(tx.significant_tokens(F.col("user"))) < 3, F.array_union(tx.significant_tokens(F.col("user")), tx.significant_tokens(F.coalesce("topic", F.lit(""))))).otherwise(tx.significant_tokens(F.col("user")))
    rows = items.withColumns({"_ground": F.coalesce(ground, F.array().cast("array<string>")), "_said": tx.significant_tokens(F.coalesce("reply", F.lit("")))})
    sizes = items.groupBy(F.col("batch_id").alias("_batch")).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    dealt = rows.select("batch_id", "item_id", "_ground", "_said").join(sizes, F.col("batch_id").eqNullSafe(F.col("_batch")))
    index = dealt.where(F.size("_ground") > 0).select("batch_id", F.pmod(F.xxhash64("item_id"), F.col("_blocks")).cast("int").alias("block"), F.lit(False).alias("probe"), "item_id", F.col("_ground").alias("tokens"))
    probes = dealt.where(F.size("_said") > 0).select("batch_id", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"), F.lit(True).alias("probe"), "item_id", F.col("_said").alias("tokens"))
    kind = {c: items.schema[c].dataType.simpleString() for c in ("batch_id", "item_id")}

    def look(key, pdf: pd.DataFrame) -> pd.DataFrame:
        probes = pdf[pdf["probe"]]
        return pd.DataFrame({"b": [key[0]] * len(probes), "i": probes["item_id"].tolist(), "best": _best(pdf[~pdf["probe"]], probes)})

    found = index.unionByName(probes).groupBy("batch_id", "block").applyInPandas(look, f"b {kind['batch_id']}, i {kind['item_id']}, best long")
    best = found.groupBy("b", "i").agg(F.max("best").alias("_best"))
    out = rows.join(best, F.col("batch_id").eqNullSafe(F.col("b")) & F.col("item_id").eqNullSafe(F.col("i")), "left").drop("b", "i")
    out = out.withColumns({"own": F.size(F.array_intersect("_said", "_ground")).cast("long"), "best_other": F.coalesce("_best", F.lit(0))})
    hit = (F.size("_said") > 0) & (((F.col("best_other") >= 2) & (F.col("best_other") >= F.col("own") + 2)) | ((F.col("own") == 0) & (F.size("_ground") >= 4) & (F.col("best_other") >= 2)))
    return out.withColumn("suspicious", hit).drop("_ground", "_said", "_best")
