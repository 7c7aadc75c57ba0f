"""Closed-form numbers: pass@k, schedules, memory, DPO. Column expressions, so that grids of plans are DataFrames."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024**3


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """1 - C(n-c, k) / C(n, k); k above n: whether any passed; impossible numbers are an error."""
    if k < 1:
        raise ValueError("k is 1 at least")
    missed = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0), lambda a, i: a * (n - c - i) / (n - i))
    found = F.when(F.lit(k) > n, F.when(c > 0, 1.0).otherwise(0.0)).when(n - c < k, 1.0).otherwise(1 - missed)
    return F.when((n < 1) | (c < 0) | (c > n), F.raise_error(F.lit("pass@k: no such counts")).cast("double")).otherwise(found)


def warmup_steps(total: Column, ratio: Column) -> Column:
    return F.floor(total * ratio)


def learning_rate(step: Column, total: Column, warmup: Column, base: Column) -> Column:
    """Linear warm-up, then a cosine down to five per cent."""
    progress = F.least(F.lit(1.0), (step - warmup) / F.greatest(F.lit(1), total - warmup))
    return F.when(step < warmup, base * (step + 1) / warmup).when(step >= total, base * 0.05).otherwise(base * (0.05 + 0.475 * (1 + F.cos(F.lit(math.pi) * progress))))


def training_steps(examples: Column, batch: Column, accumulation: Column, epochs: Column) -> Column:
    """Optimiser steps; a partial window at an epoch's end steps too."""
    return F.greatest(F.lit(1), F.ceil(examples / (batch * accumulation))) * epochs


def push_steps(every: Column, total: Column) -> Column:
    """Every every-th step below the total, and the total."""
    return F.array_sort(F.array_union(F.when(every < total, F.sequence(every, total - 1, every)).otherwise(F.array().cast("array<bigint>")), F.array(total)))


def pushes_at(step: Column, every: Column, total: Column) -> Column:
    return (step % every == 0) | (step == total)


def final_push_pending(step: Column, last_pushed: Column) -> Column:
    return (step > 0) & ~F.coalesce(last_pushed, F.lit(-1)).eqNullSafe(step)


def memory_terms(*, params, trained, context, batch, layers, hidden, vocab, linear_layers, state_bytes, share=1.0, models=1, quantised=False, adafactor=True, checkpointing=True, selective=True) -> dict[str, Column]:
    """Six terms in GB; params, context and the like are columns."""
    tokens = context * batch
    weights = params / 1e9 * (0.5 if quantised else 2.0) * models
    gradients = trained * 2 / 1e9
    optimiser = F.lit(0.02) if adafactor else trained * 8 / 1e9
    stored = layers * tokens * hidden * 2 / GIB
    transient = (state_bytes * tokens * (1 if checkpointing else linear_layers) + tokens * hidden * 16 * (1 if checkpointing else layers)) / GIB
    loss = (share if selective else F.lit(1.0)) * tokens * vocab * 4 / GIB
    resident = weights + gradients + optimiser
    return {"weights": weights, "gradients": gradients, "optimiser": optimiser, "stored": stored, "transient": transient, "loss": loss, "resident": resident, "total": resident + stored + transient + loss}


def dpo_margin(policy_chosen: Column, policy_rejected: Column, reference_chosen: Column, reference_rejected: Column) -> Column:
    return (policy_chosen - reference_chosen) - (policy_rejected - reference_rejected)


def dpo_loss(margin: Column, beta: float = 0.1) -> Column:
    """-log sigmoid(beta * margin), stable on both sides."""
    x = margin * beta
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def vision_tokens(grid: Column, merge: Column) -> Column:
    return F.floor(grid[0] * grid[1] * grid[2] / (merge * merge)).cast("int")
