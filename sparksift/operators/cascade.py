"""The cascade of cheap and dear judgements: gate, model roles, reply parsing, consensus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.storage import written
from ..schemas import VERDICT, VERDICTS

#: (host, excerpt, role) to raw reply. Clients are injected; tests and queries use `stub_client`.
Client = Callable[[str, str, str], str]


def gate(p: Column, config: Config) -> Column:
    """flag at the upper threshold or more, clear at the lower or less, else null; null stays undecided."""
    return F.when(p >= config.high, "flag").when(p <= config.low, "clear")


def reply_fields(raw: Column) -> dict[str, Column]:
    """verdict, confidence, valid, repaired: the reply as it is, else its outermost braces, else nothing."""
    good = lambda x: F.when(x["verdict"].isin(*VERDICTS) & x["confidence"].between(0, 1), x)
    direct = good(F.from_json(raw, VERDICT, {"mode": "PERMISSIVE"}))
    inner = good(F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), VERDICT, {"mode": "PERMISSIVE"}))
    best = F.coalesce(direct, inner)
    return {"verdict": best["verdict"], "confidence": best["confidence"], "valid": best.isNotNull(), "repaired": direct.isNull() & inner.isNotNull()}


def stub_client(host: str, excerpt: str, role: str) -> str:
    """A deterministic stand-in for a model."""
    words = excerpt.lower().split()
    hits = sum(w.strip(".,") in ("bet", "bets", "casino", "jackpot", "spin", "odds", "pills", "win") for w in words)
    hits += any(x in host for x in ("casino", "bets", "pills", "spam"))
    verdict = "flag" if hits >= (2 if role == "validator" else 1) else "clear"
    body = f'{{"verdict": "{verdict}", "confidence": {min(0.5 + 0.1 * hits, 0.99) if verdict == "flag" else 0.9}}}'
    return f"```json\n{body}\n```" if role == "validator" else body


def call_model(pages: DataFrame, role: str, client: Client, config: Config) -> DataFrame:
    """host, excerpt to host, role, raw, tokens. At most ai_concurrency calls run at once; the result is written, so nothing calls again.

    Hosts whose reply is invalid are asked again, json_retries times at most; tokens count all of their calls.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = [client(h, e or "", role) for h, e in zip(f["host"], f["excerpt"])]
            yield pd.DataFrame({"host": f["host"], "role": role, "raw": raw, "tokens": [len((e or "").split()) + len(r.split()) for e, r in zip(f["excerpt"], raw)]})

    def ask(rows: DataFrame) -> DataFrame:
        asked = rows.select("host", "excerpt").repartition(config.ai_concurrency)
        return written(asked.mapInPandas(run, "host string, role string, raw string, tokens long"), f"replies-{role}")

    replies = ask(pages)
    for _ in range(config.json_retries):
        invalid = replies.filter(~reply_fields(F.col("raw"))["valid"]).select("host")
        if invalid.isEmpty():
            break
        again = ask(pages.join(invalid, "host", "left_semi")).select("host", F.col("raw").alias("new"), F.col("tokens").alias("more"))
        both = replies.join(again, "host", "left").select("host", "role", F.coalesce("new", "raw").alias("raw"), (F.col("tokens") + F.coalesce("more", F.lit(0))).alias("tokens"))
        replies = written(both, f"replies-{role}")
    return replies


def consensus(primary: Column, validator: Column, tiebreaker: Column) -> dict[str, Column]:
    """Equal verdicts stand; else the tiebreaker decides; without one the outcome is unsure, never a silent flag."""
    agree = primary.eqNullSafe(validator) & primary.isNotNull()
    return {
        "verdict": F.when(agree, primary).otherwise(F.coalesce(tiebreaker, F.lit("unsure"))),
        "decided_by": F.when(agree, "agreed").when(tiebreaker.isNotNull(), "tiebreaker").otherwise("none"),
    }


#: Content of a screenshot to a verdict.
Vision = Callable[[bytes], str]


def stub_vision(content: bytes) -> str:
    """A deterministic stand-in for a model that looks at screenshots."""
    return "flag" if any(x in content for x in (b"casino", b"bets", b"pills", b"spam")) else "clear"


def vision_check(shots: DataFrame, config: Config, client: Vision = stub_vision) -> DataFrame:
    """path, content to name, verdict: at most check_concurrency looks at once, written, so that none is done twice."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"name": f["path"].str.rsplit("/", n=1).str[-1], "verdict": [client(bytes(x)) for x in f["content"]]})

    return written(shots.select("path", "content").repartition(config.check_concurrency).mapInPandas(run, "name string, verdict string"), "vision")


def classify(pages: DataFrame, config: Config, client: Client = stub_client, store=None) -> DataFrame:
    """host, excerpt and, if there is one, p to host, verdict, decided_by, tokens: validator after primary, tiebreaker only on disagreement.

    With a store of replies (replies.ReplyStore) only what it lacks is asked; a host then has one excerpt, and hosts that
    the store's quota leaves unasked aren't in the result.

    With p, the fast path's probability, the gate is asked first, and only hosts that it leaves open go to a model. In
    fast mode a confident primary needs no validator.
    """
    if "p" in pages.columns:
        judged = gate(F.col("p"), config)
        sure = pages.filter(judged.isNotNull()).select("host", judged.alias("verdict"), F.lit("gate").alias("decided_by"), F.lit(0).cast("long").alias("tokens"))
        return sure.unionByName(classify(pages.filter(judged.isNull()).drop("p"), config, client, store))

    def ask(rows: DataFrame, role: str) -> DataFrame:
        return store.replies(rows, role, client, config) if store else call_model(rows, role, client, config)

    def parsed(replies: DataFrame, role: str) -> DataFrame:
        fields = reply_fields(F.col("raw"))
        return replies.select("host", fields["verdict"].alias(role), fields["confidence"].alias(f"{role}_confidence"), F.col("tokens").alias(f"{role}_tokens"))

    first = parsed(ask(pages, "primary"), "primary")
    sure = F.lit(config.fast_mode) & (F.coalesce("primary_confidence", F.lit(0.0)) >= config.fast_confidence)
    second = parsed(ask(pages.join(first.filter(~sure), "host", "left_semi"), "validator"), "validator")
    both = first.join(second, "host", "left").withColumn("validator", F.when(sure, F.col("primary")).otherwise(F.col("validator")))
    split = both.filter(~F.col("primary").eqNullSafe(F.col("validator")))
    third = parsed(ask(pages.join(split, "host", "left_semi"), "tiebreaker"), "tiebreaker")
    out = both.join(third, "host", "left")
    decided = consensus(F.col("primary"), F.col("validator"), F.col("tiebreaker"))
    tokens = sum((F.coalesce(f"{r}_tokens", F.lit(0)) for r in ("primary", "validator", "tiebreaker")), F.lit(0)).cast("long")
    return out.select("host", decided["verdict"].alias("verdict"), decided["decided_by"].alias("decided_by"), tokens.alias("tokens"))
