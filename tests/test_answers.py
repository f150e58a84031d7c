from strata import config as C
from strata.operators import search as S


def _reduced(spark):
    rows = [(1, "general", 0, "g1", 1), (1, "general", 1, "g2", 2), (1, "admin", 0, "a1", 1), (1, "admin", 0, "a2", 2),
            (1, "admin", 2, "a3", 3), (2, "level_q", 0, "q1", 1)]
    return spark.createDataFrame(rows, "question_id long, level string, cluster_level int, community string, rn int")


def _reports(spark):
    rows = [("general", 0, "g1", "G1", "one two three"), ("general", 1, "g2", "G2", "four five"), ("general", 1, "g9", "G9", "unused"),
            ("admin", 0, "a1", "A1", "a b c d e f g h"), ("admin", 0, "a2", "A2", "i j"), ("admin", 2, "a3", "A3", "k"),
            ("level_q", 0, "q1", "Q1", "m\nn")]
    return spark.createDataFrame(rows, "level string, cluster_level int, community string, title string, full_content string")


def test_answer_holds_every_reduced_point_of_the_budget(spark):
    got = lambda **o: {(r.question_id, r.level): r.answer for r in S.answer_rows(_reduced(spark), _reports(spark), **o).collect()}
    whole = {(1, "general"): "one two three\n\nfour five", (1, "admin"): "a b c d e f g h\n\ni j\n\nk", (2, "level_q"): "m\nn"}
    assert got() == whole
    assert got(budget=4) == {**whole, (1, "general"): "one two three", (1, "admin"): "a b c d e f g h"}     # the best stays
    assert got(text="title")[1, "admin"] == "A1\n\nA2\n\nA3"


def test_prompt_numbers_the_responses_of_the_tiers_a_user_sees(spark):
    clearance = spark.createDataFrame([(u, t) for u, ts in C.CLEARANCE.items() for t in ts], "user_level string, level string")
    questions = spark.createDataFrame([(1, "why?"), (1, "why?"), (2, "how?"), (3, None)], "item_id long, text string")
    answers = S.answer_rows(_reduced(spark), _reports(spark), "title")
    got = {(r.question_id, r.level): r for r in S.answer_prompts(answers, questions, clearance).collect()}
    assert sorted(got) == [(1, "admin"), (1, "general"), (2, "level_q")]
    head = "Please synthesize the following responses to answer the question:\n\n"
    assert got[1, "general"].prompt == head + "Response 1:\nG1\n\nG2\n\nQuestion: why?Answer: "
    assert got[1, "admin"].prompt == head + "Response 1:\nG1\n\nG2\n\nResponse 2:\nA1\n\nA2\n\nA3\n\nQuestion: why?Answer: "
    assert (got[1, "admin"].n_responses, got[1, "admin"].answer) == (2, "A1\n\nA2\n\nA3")
    assert got[2, "level_q"].prompt == head + "Response 1:\nQ1\n\nQuestion: how?Answer: "
