"""Patterns, word lists, thresholds and enums that results depend on.

Patterns use the syntax that Java and RE2 share; ``\\p{L}\\p{N}_`` stands for a Unicode word character.
"""

# --- fixed values: characters ---
WORD = r"[\p{L}\p{N}_]+"
#: Letters and digits of the SQL engine's WORD that Java 17's lacks, and capitals that ICU lowers and the SQL engine leaves (code points in hexadecimal).
NEWER_LETTERS = (
    "870-887 889-88e 8b5 8c8-8c9 c5d cdd 170d 171f 1b4c 2c2f 2c5f 9ffd-9fff a7c0-a7c1 a7d0-a7d1 "
    "a7d3 a7d5-a7d9 a7f2-a7f4 10570-1057a 1057c-1058a 1058c-10592 10594-10595 10597-105a1 105a3-105b1 105b3-105b9 105bb-105bc 10780-10785 10787-107b0 107b2-107ba "
    "10f70-10f81 11071-11072 11075 1123f-11240 11740-11746 11ab0-11abf 11f02 11f04-11f10 11f12-11f33 11f50-11f59 12f90-12ff0 1342f 13441-13446 16a70-16abe "
    "16ac0-16ac9 1aff0-1aff3 1aff5-1affb 1affd-1affe 1b11f-1b122 1b132 1b155 1d2c0-1d2d3 1df00-1df1e 1df25-1df2a 1e030-1e06d 1e290-1e2ad 1e4d0-1e4eb 1e4f0-1e4f9 "
    "1e7e0-1e7e6 1e7e8-1e7eb 1e7ed-1e7ee 1e7f0-1e7fe 2a6de-2a6df 2b735-2b739 31350-323af"
)
UNCASED = r"[\x{1c89}\x{a7cb}\x{a7cc}\x{a7da}\x{a7dc}\x{10d50}-\x{10d65}]"
TERMINAL = ".!?)\"'”»"

# --- fixed values: text patterns ---
DANGLING_END = r"(:|—|–|•)\s*$"
OPTION_LINE_START = r"(?i)^\s*Option\s+([A-D])\b\s*[:.)]\s*"
OPTION_LINE_ANY = r"(?i)Option\s+([A-D])\b\s*[:.)]"
SOLUTION_TO_QUESTION = r"(?i)Solution\s+to\s+Question\s+(\d{1,3})"
EXPLANATION_START = (
    r"(?i)^\s*(?:option\s+[a-d]\s*[:.)\-]|ans(?:wer)?\s*[:.)\-]|the\s+correct\s+(?:answer|option)\b|"
    r"(?:hence|thus|therefore|so)\s*,\s*(?:the\s+)?(?:correct\s+)?option\b|"
    r"correct\s+answer\s+is\b|the\s+(?:correct\s+)?answer\s+is\b|"
    r"solution\s*[:.)\-]|explanation\s*[:.)\-]|answer\s*[:.)\-]|"
    r"solution\s+to\s+question\s+\d+|explanation\s+of\s+question\s+\d+)"
)
QUESTION_SHAPED = (
    r"(?i)\?\s*$|which\b|what\b|who\b|whom\b|how\b|why\b|identify\b|choose\b|select\b|best\b|most likely\b|correct\b|"
    r"diagnos|drug\b|treatment\b|following\b|regarding\b|according\b|is the\b|are the\b|of the\b"
)
NOISE_LINES = (
    r"^\s*[-–—.·]?\s*\d{1,4}\s*[-–—.·]?\s*$",
    r"(?i)^\s*page\s*\d{1,4}\s*(of\s*\d{1,4})?\s*$",
    r"(?i)^\s*(https?://|www\.)\S+\s*$",
    r"(?i)^\s*(©|\(c\)|copyright).*$",
)
PRINTED_STEM = r"(?m)^\s*(?:Q(?:uestion)?\s*[.:]?\s*)?(\d{1,3})\s*[.:\-–)]"
KEY_ROW_PIPE = r"(?m)^\s*\|\s*(\d{1,3})\s*\|\s*([A-Da-d])\s*\|"
KEY_ROW_DOT = r"(?m)^\s*(\d{1,3})\s*[.)]\s*([A-Da-d])\s*$"
KEY_ROW_DASH = r"(?m)^\s*(\d{1,3})\s*[-–]\s*([A-Da-d])\s*$"
DIGEST_ROW_GAP = r"(?m)^\s*(\d{1,3})\s{2,}([A-Da-d])\s*$"
DIGEST_ROW_PIPE = r"\|\s*(\d{1,3})\s*\|\s*([A-Da-d])\s*\|"
KEY_PROBE = r"(?i)(question\s*no|q\.?\s*no)[^\n]{0,40}(correct\s*option|answer)|answer\s*key"
NUMBER_WITH_UNIT = (
    r"(?i)\b(\d+(?:[.,]\d+)*)\s*(cGy|Gy|cgy|mg|g|kg|cm|mm|µg|IU|iu|%|mmHg|cmH2O|minutes?|mins?|weeks?|wks?|days?|hours?|hrs?)\b"
)

# --- fixed values: thresholds ---
AUTO_APPLY_MIN, HUMAN_QUEUE_MIN, DELETE_AUTO_MIN = 0.95, 0.80, 0.98
MAX_AUDIT_ATTEMPTS = 2
ANSWER_KEY_ONLY_MIN_SHARE, ANSWER_KEY_ONLY_MIN_ROWS = 0.8, 5
SUSPECT_DENSITY_MIN, SUSPECT_DENSITY_MULT = 0.5, 3.0
MIN_IMAGE_BYTES = 1500
SOFT_CAP_QUESTION, SOFT_CAP_SOLUTION = 3, 2
CEILING_QUESTION, CEILING_SOLUTION = 8, 6
CONTAMINATION_SHARE, CONTAMINATION_MIN_LEN, MAX_REAL_STEM_LEN = 0.8, 60, 250
DUP_MIN_LEN, DUP_LEN_RATIO, DUP_PREFIX, DUP_RATIO = 80, 1.2, 400, 0.95
SEGMENT_TEXT_LEN, SEGMENT_N, SEGMENT_MIN_SHINGLES, SEGMENT_MIN_CHARS = 400, 8, 25, 250
TABLE_ROW_DEFICIT = 3
SHORT_SOLUTION = 60
DRIFT_MIN_LEN = 40
SOLUTION_GATE = 0.6
FRAGMENT_PRESENT = 0.85
TOC_FIRST, TOC_STEP, TOC_CAP = 8, 8, 40
COOLDOWN_SECONDS, DAILY_CAP = 60, 480
REVIEW_PAGE, DETAIL_LEN, KEY_LEN, SAMPLE_EVERY = 25, 400, 16, 15

# --- fixed values: enums ---
GRADES = ("RESOLVED_ANCHORED", "RESOLVED", "PROVISIONAL", "UNRESOLVED")
BLOCKER_KINDS = ("answer_key_disagrees", "incomplete_records", "unresolved_qid")
FLAG_FILES = (
    "export_gate.jsonl", "export_gate_advisory.jsonl", "integrity_flags.jsonl", "orphans.jsonl",
    "still_incomplete_after_retry.jsonl", "stem_conflicts.jsonl", "unmatched_images.jsonl", "unresolved_images.jsonl",
)
SPLIT_FILES = (
    "questions.jsonl", "answers.jsonl", "solutions.jsonl", "unresolved_qids.jsonl", "orphans.jsonl", "chapter_completeness.json", "image_manifest.jsonl",
)
STATUSES = ("COMPLETE", "INCOMPLETE")
CORE_FILES = (
    "questions.jsonl", "image_ownership.jsonl", "page_ledger.jsonl", "chapters.json", "human_edit_ledger.jsonl",
    "review_decisions.jsonl", "ai_auto_resolved.jsonl", "verify_counter.json",
)
