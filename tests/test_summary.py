from strata.operators.graph import distinct_texts, sorted_summary


def test_summary_sorted_distinct_and_capped(spark):
    rows = [("t", "HUB", f"sentence {i:04d} " + "word " * 20) for i in range(300)]
    rows += [("t", "HUB", "sentence 0000 " + "word " * 20)]          # duplicate
    rows += [("t", "HUB", "")]                                        # empty: dropped
    rows += [("t", "BIG", "x " * 800)]                                 # single text above the cap: kept
    df = spark.createDataFrame(rows, "level string, title string, description string")
    got = {r.title: r.summary for r in sorted_summary(distinct_texts(df, ["level", "title"]), ["level", "title"]).collect()}
    hub = got["HUB"].split()
    assert len(hub) <= 500
    starts = [i for i, w in enumerate(hub) if w == "sentence"]
    nums = [hub[i + 1] for i in starts]
    assert nums == sorted(nums) and len(nums) == len(set(nums))     # sorted, distinct
    assert nums[0] == "0000"
    assert len(got["BIG"].split()) >= 800
