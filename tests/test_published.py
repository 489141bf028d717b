"""A result that is published more than once is computed once."""

from lectern.plans import sources


def test_published_results_are_computed_once(spark, sf, monkeypatch):
    plans, publish = [], sources.P.publish

    def watched(results, root):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for name, df in results.items() if name == "video_timeline")
        publish(results, root)

    monkeypatch.setattr(sources.P, "publish", watched)
    assert {r.result: r.refused for r in sources.QUERIES["published_results"](spark, sf).collect()} == dict.fromkeys(["course_enrollment_daily", "course_enrollment_mode_daily", "video_timeline"], True)
    assert len(plans) == 3 and not any("Aggregate" in p or "Window" in p for p in plans)
