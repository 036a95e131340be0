"""Models in batches: set-up, failing rows, replies that cannot be read."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import batch_model
from broadsheet.operators.relevance import score_relevance
from broadsheet.operators.triage import triage
from broadsheet.operators.validate import judge_dates
from broadsheet.settings import Settings

ARTICLE = "ord BIGINT, title STRING, url STRING, domain STRING, seendate STRING, api_source STRING, tier INT, reasoning STRING"


def articles(spark, titles):
    rows = [(i, title, f"https://x.org/{i}", "x.org", "Unknown", "rss", 1, "") for i, title in enumerate(titles)]
    return spark.createDataFrame(rows, ARTICLE)


def model():
    """Fails on any batch with a prompt that holds BAD; counts its set-ups in the reply."""
    model.setups = getattr(model, "setups", 0) + 1

    def reply(prompts):
        if any("BAD" in prompt for prompt in prompts):
            raise RuntimeError("refused")
        return [f"{model.setups}/{len(prompts)}/{prompt}" for prompt in prompts]

    return reply


def test_one_bad_row_costs_only_itself(spark):
    df = spark.createDataFrame([(i, "BAD" if i == 5 else f"p{i}" if i else None, None) for i in range(10)], "i INT, p STRING, extra DATE").coalesce(1)
    found = {row["i"]: row for row in batch_model.ask(df, F.col("p"), model, batch_rows=4).collect()}
    assert len(found) == 10 and all(row["extra"] is None for row in found.values())
    assert (found[5]["reply"], found[5]["error"]) == (None, "RuntimeError: refused")
    assert {found[i]["reply"].split("/", 1)[1] for i in (0, 1)} == {"4/", "4/p1"}
    # Asked row by row after its batch failed, and by the same model.
    assert found[4]["reply"].split("/", 1)[1] == "1/p4"
    assert len({row["reply"].split("/")[0] for row in found.values() if row["reply"]}) == 1
    assert all((row["reply"] is None) != (row["error"] is None) for row in found.values())


def test_short_replies_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "_prompt INT, p STRING").coalesce(1)
    short = batch_model.ask(df, F.col("p"), lambda: lambda prompts: prompts[1:])
    assert {row["error"] for row in short.collect()} == {"ValueError: 0 replies to 1 prompts"}
    assert batch_model.ask(df.limit(0), F.col("p"), model).columns == ["_prompt", "p", "reply", "error"]
    assert batch_model.ask(df.limit(0), F.col("p"), model).count() == 0
    with pytest.raises(ValueError):
        batch_model.ask(df.withColumnRenamed("p", "Reply"), F.col("Reply"), model)


def relevance():
    def reply(prompts):
        if any("BAD" in prompt for prompt in prompts):
            raise RuntimeError("refused")
        return ["no json" if "ODD" in p else json.dumps({"is_relevant": "yes " if "GOOD" in p else "no", "reasoning": p[:4]}) for p in prompts]

    return reply


def test_scorer_drops_what_failed(spark):
    df = articles(spark, ["GOOD one", "BAD one", "ODD one", "other", "GOOD two"])
    scored = {row["ord"]: row for row in batch_model.batch_scorer(relevance)(df).collect()}
    assert [scored[i]["error"] for i in range(5)] == [None, "RuntimeError: refused", "unreadable reply", None, None]
    kept = score_relevance(df, batch_model.batch_scorer(relevance))
    assert kept.columns == df.columns and sorted((row["ord"], row["reasoning"]) for row in kept.collect()) == [(0, "GOOD"), (4, "GOOD")]


def test_extractor(spark):
    def dates():
        return lambda prompts: [1 / 0 if "BAD" in p else "2024-01-30" for p in prompts]

    df = articles(spark, ["one story", "BAD story"])
    judged = judge_dates(df, Settings(as_of=datetime(2024, 1, 31)), batch_model.batch_extractor(dates))
    found = {row["ord"]: (row["pub_date"], row["drop_reason"]) for row in judged.collect()}
    assert found == {0: (date(2024, 1, 30), None), 1: (None, "unverifiable")}


def test_reviewer_keeps_a_failed_list_whole(spark):
    def evens():
        def reply(prompts):
            if any("BAD" in prompt for prompt in prompts):
                raise RuntimeError("refused")
            lines = prompts[0].split("\n")
            return ["```json\n" + json.dumps({"retained_indices": [i for i in range(0, len(lines), 2)] + [99]}) + "\n```"]

        return reply

    df = articles(spark, [f"story {i}" if i != 5 else "BAD story" for i in range(11)])
    kept = triage(df, reviewer=batch_model.batch_reviewer(evens, block=4))
    # Lists 0-3, 4-7 and 8-10: the middle one fails.
    assert sorted(row["ord"] for row in kept.collect()) == [0, 2, 4, 5, 6, 7, 8, 10]
    assert triage(df.limit(0), reviewer=batch_model.batch_reviewer(evens)).count() == 0
