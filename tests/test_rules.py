import pytest

from recordforge.operators import rules as R
from recordforge.operators import records as N

OPTS = [("A", "optic nerve fibres"), ("B", "corneal surface layer"), ("C", "retinal ganglion cells"), ("D", "ciliary body muscle")]
BASE = dict(chapter="S-001", q_no=1, stem="Which layer?", options=OPTS, correct=["B"], solution="The corneal surface layer is right, as the first test of the lens shows in most cases.", tables=[], question_images=1, solution_images=1,
            declared_question=True, declared_solution=True, qa_status="READY", stem_suspect=None, options_suspect=None)
KEY = ("Answer key", "| Question | Correct Option |\n|---|---|\n| 1 | A |")
CASES = {
    "clean": ({}, set()),
    "incomplete": ({"qa_status": "INCOMPLETE"}, {"qa_incomplete"}),
    "empty": ({"stem": " "}, {"empty_question"}),
    "options": ({"options": OPTS[:3]}, {"bad_options"}),
    "blank key": ({"options": [*OPTS[:1], ("B", " "), *OPTS[2:]]}, {"bad_options", "blank_correct_option"}),
    "no answer": ({"correct": []}, {"missing_answer"}),
    "foreign answer": ({"correct": ["E"]}, {"answer_mismatch", "blank_correct_option"}),
    "opener": ({"stem": "Explanation: the lens"}, {"contaminated_question"}),
    "noise": ({"solution": BASE["solution"] + "\nPage 3 of 9"}, {"ocr_noise_solution"}),
    "missing": ({"solution": None}, {"missing_solution"}),
    "cut": ({"solution": "The corneal surface layer comes first because "}, {"truncated_solution"}),
    "lead-in": ({"solution": "The corneal surface layers are listed below:"}, set()),
    "lead-in bare": ({"solution": "The corneal surface layers are listed below:", "solution_images": 0, "declared_solution": False}, {"truncated_solution"}),
    "short": ({"solution": "corneal layer", "solution_images": 0, "declared_solution": False}, {"short_bare_solution"}),
    "header": ({"solution": "Solution to Question 1: " + BASE["solution"]}, {"solution_header_furniture"}),
    "dump": ({"solution": BASE["solution"] + " Solution to Question 4: more text."}, {"solution_recitation_dump"}),
    "foreign head": ({"solution": "Option A: zonular apparatus holds it in place over the years, firmly and well."}, {"foreign_option_head", "option_solution_disagree"}),
    "agreeing head": ({"solution": "Option A: the optic nerve fibres carry the signal from the eye to the brain itself."}, set()),
    "many images": ({"question_images": 9, "solution_images": 7}, {"over_attributed_images", "over_attributed_solution_images"}),
    "lost figure": ({"question_images": 0}, {"declared_figure_missing"}),
    "twin tables": ({"tables": [("t", "| a |"), ("t", "|  A |")]}, {"duplicate_table"}),
    "key table": ({"tables": [KEY]}, {"stray_answer_key_table"}),
}


@pytest.fixture(scope="module")
def flags(spark):
    rows = [tuple({**BASE, "q_no": i, **change}.values()) for i, (change, _) in enumerate(CASES.values())]
    found = {}
    for r in R.row_flags(spark.createDataFrame(rows, R.RECORD)).collect():
        found.setdefault(r.q_no, set()).add(r.kind)
    return found


@pytest.mark.parametrize("i", range(len(CASES)), ids=list(CASES))
def test_row_rules(flags, i):
    assert flags.get(i, set()) == list(CASES.values())[i][1]


def test_gaps_and_runs(spark):
    rows = spark.createDataFrame([("a", n) for n in (2, 3, 3, 7, None)] + [("b", 1)], "chapter string, q_no long")
    assert [(r.chapter, r.from_no, r.to_no) for r in N.numbering_gaps(rows).collect()] == [("a", 4, 6)]
    assert [(r.chapter, r.first_no) for r in N.numbering_start(rows).collect()] == [("a", 2)]
    assert {(r.chapter, r.first_no, r.last_no, r.trusted) for r in N.connected_runs(rows).collect()} == {("a", 2, 3, False), ("a", 7, 7, True), ("b", 1, 1, True)}


def test_upper_median_and_density(spark):
    rates = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.3), ("d", 0.95)], "chapter string, rate double")
    got = {r.chapter: (r.median, r.alarm) for r in N.density(rates).collect()}
    assert got["d"] == (0.3, True) and got["c"] == (0.3, False)
