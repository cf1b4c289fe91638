"""Fixed values that must equal the behaviour being reproduced.

Everything here is data, not logic: operators take these as parameters so a
user can pass other rules without touching code.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: whitespace. Python's str.split()/str.strip() whitespace set,
# spelled out so Java regex (Spark) and RE2 (DuckDB oracle) agree with it.
# ---------------------------------------------------------------------------
WS_CLASS = (r"\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
            r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# the same set without the line feed (whitespace inside one line)
WS_CLASS_NO_NL = (r"\t\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
                  r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_CLASS}]"
# the same set as literal characters (for trim functions)
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
NON_WS = f"[^{WS_CLASS}]"

# ---------------------------------------------------------------------------
# FIXED VALUES: per-source text markers (applied in this order).
# mode "before": keep the text before the first occurrence;
# mode "after_last": keep the text after the last occurrence.
# ---------------------------------------------------------------------------
MARKER_RULES = [
    ("protothema.gr", "before", "Συνεχίζοντας σε αυτό τον ιστότοπο"),
    ("protothema.gr", "after_last", "Advertorial"),
    ("kathimerini.gr", "before", "Συνδρομητικό περιεχόμενο"),
    ("kathimerini.gr", "before", "Αποκλειστικά για συνδρομητές"),
    ("kathimerini.gr", "before", "ΣΥΝΔΡΟΜΗ"),
    ("tanea.gr", "before", "Διαβάστε επίσης"),
    ("tanea.gr", "before", "ΔΙΑΒΑΣΤΕ ΑΚΟΜΑ"),
    ("tanea.gr", "before", "Δείτε επίσης"),
    ("tovima.gr", "before", "Διαβάστε επίσης"),
    ("tovima.gr", "before", "Δείτε ακόμα"),
    ("tovima.gr", "before", "Περισσότερα"),
]
# The general cleaner cuts at "Ειδήσεις σήμερα:" and then at "Ειδήσεις σήμερα";
# the second is a prefix of the first, so one cut at the shorter marker is the same.
GENERAL_MARKER = "Ειδήσεις σήμερα"
VIDEO_SENTENCE = (" To view this video please enable JavaScript, and consider upgrading"
                  " to a web browser that supports HTML5 video")

# FIXED VALUES: markdown stop phrases (matched lower-cased, substring).
STOP_PHRASES = ["προσθηκη σχολιου", "διαβάστε ακόμα", "δημοφιλη", "read more"]
MIN_WORDS_PER_LINE = 5
# FIXED VALUES: markdown patterns (image, link with its words, bare address).
MD_IMAGE = r"!\[.*?\]\(.*?\)"
MD_LINK = r"\[(.*?)\]\(.*?\)"
MD_URL = f"https?://{NON_WS}+"
MIN_TEXT_CHARS = 150

# FIXED VALUES: URL keywords excluded from sitemaps (lower-cased substring).
URL_EXCLUDE_KEYWORDS = ["author", "categor", "tag", "page-sitemap", "product"]

# ---------------------------------------------------------------------------
# FIXED VALUES: band specs. (upper edges, labels); a value belongs to the first
# band whose upper edge it does not exceed.
# ---------------------------------------------------------------------------
IDEOLOGY_CLASSES = ["Far-Left", "Left", "Center-Left", "Center / Neutral",
                    "Center-Right", "Right", "Far-Right"]
IDEOLOGY_EDGES = [0.15, 0.35, 0.45, 0.55, 0.65, 0.85]  # last class open-ended

RANGE5_EVEN = {
    "edges": [0.0, 0.2, 0.4, 0.6, 0.8, 1.0],
    "labels": ["Far-Left (0-0.2)", "Left (0.2-0.4)", "Neutral (0.4-0.6)",
               "Right (0.6-0.8)", "Far-Right (0.8-1.0)"],
}
RANGE5_TAIL = {
    "edges": [0.0, 0.15, 0.4, 0.6, 0.85, 1.0],
    "labels": ["Far-Left (0-0.15)", "Left (0.15-0.4)", "Neutral (0.4-0.6)",
               "Right (0.6-0.85)", "Far-Right (0.85-1.0)"],
}
LEAN_FEED = (0.4, 0.6)        # < lo Left, > hi Right, else Center
LEAN_ANALYZER = (0.35, 0.66)  # <= lo Left, >= hi Right, else Center
LEAN_DASH = (40, 60)          # <= lo Left, <= hi Center, else Right

# FIXED VALUES: agreement verdicts (upper bounds, exclusive).
MAE_VERDICTS = [(0.05, "outstanding"), (0.12, "good"), (0.20, "acceptable")]
MAE_VERDICT_ELSE = "discrepancy"
LEGACY_VERDICTS = [(1.5, "outstanding"), (3.0, "good")]
LEGACY_VERDICT_ELSE = "needs work"

# ---------------------------------------------------------------------------
# FIXED VALUES: legacy categorical score map.
# ---------------------------------------------------------------------------
LEGACY_SCORES = {
    "sentiment": {"negative": -1, "neutral": 0, "positive": 1},
    "ideological_leaning": {"far-left": -3, "left": -2, "center-left": -1, "center": 0,
                            "center-right": 1, "right": 2, "far-right": 3, "neutral": 0},
    "establishment_stance": {"pro-government": 2, "anti-government": -2, "systemic": 1,
                             "anti-systemic": -1, "neutral": 0},
}
LEGACY_UNKNOWN_PREDICTION = 5
LEGACY_ERROR_PENALTY = 10
LEGACY_FALLACY_WEIGHT = 2

# FIXED VALUES: prompt / chat rendering.
TITLE_LABEL = "ΤΙΤΛΟΣ: "
BODY_LABEL = "ΚΕΙΜΕΝΟ: "
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"
FEED_PAGE_SIZE = 25
XML_CAP = 3  # sub-sitemaps followed per domain
RECENT_SIZE = 5
PER_SOURCE = 2000  # articles of a source in the historical dataset
LEFT_CAP = 500
NEUTRAL_SLICES = [(0, 599), (600, 848), (849, 1047)]
FAR_RIGHT_TRIM = 93
LOOKBACK_HOURS = 2
SEED = 42

# FIXED VALUES: feed-card display defaults.
FEED_DEFAULTS = {"title": "No Title", "source": "Unknown Source", "url": "#", "date": "",
                 "reasoning": "Analysis pending..."}
FEED_DEFAULT_SCORE = 0.5
DASH_DEFAULT_SCORE = 50

# FIXED VALUES: marks of a model's thoughts in its output: a closed block, an orphan closing tag, a block's contents.
THOUGHT_BLOCK = r"(?is)<(reasoning|think)>.*?</\1>"
THOUGHT_TAIL = r"(?is)^.*?</(?:reasoning|think)>"
THOUGHT_TEXT = r"(?is)<(?:reasoning|think)>(.*?)</(?:reasoning|think)>"
