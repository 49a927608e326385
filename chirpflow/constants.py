"""Fixed values that results depend on.

Everything here is data, not logic: patterns, word lists and the default
keyword-to-topic table.  Change them only together with the tests.
"""

from __future__ import annotations

# --- Fixed values: regular expressions (Java regex syntax, RE2-compatible) ---

# A URL and everything after it on the same line.  (?d) (UNIX_LINES) makes `.`
# stop only at "\n", like Python's `.`; plain Java `.` also stops at \r, U+0085,
# U+2028 and U+2029.
URL_TO_EOL = r"(?d)https?.*"

# URL as a single whitespace-free token (the "token" cleaning mode).
URL_TOKEN = r"https?\S*"

# ASCII digit runs.  Java's \d is ASCII-only, so Eastern Arabic digits survive.
DIGITS = r"\d+"

# Python's str.split() separators, written out so Java and RE2 agree.  Java's
# (?U)\s lacks U+001C..U+001F, and RE2's \s is ASCII-only.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PY_WHITESPACE_RUN = PY_WHITESPACE_CLASS + "+"

# Python's Unicode \w: letters, numbers (Nd, Nl, No) and underscore.  Java's
# (?U)\w differs (it takes combining marks and leaves out No digits such as
# "²"), so the class is written out; RE2 reads it the same way.
PY_WORD_CLASS = r"[\p{L}\p{N}_]"

# Retweet marker "RT @handle: " anywhere in the text, with Python's \s and \w.
RETWEET_MARKER = "RT" + PY_WHITESPACE_CLASS + "@" + PY_WORD_CLASS + "*:" + PY_WHITESPACE_CLASS

# Non-word separator of the English tokenizer (ASCII \W, as MLlib's default).
NON_WORD = r"\W"
NON_WORD_UNICODE = r"(?U)\W"

# --- Fixed values: Spark MLlib's default English stop-word list (181 words) ---
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him "
    "his himself she her hers herself it its itself they them their theirs themselves "
    "what which who whom this that these those am is are was were be been being have "
    "has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above "
    "below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no nor "
    "not only own same so than too very s t can will just don should now i'll you'll "
    "he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's "
    "she's it's we're they're i've we've you've they've isn't aren't wasn't weren't "
    "haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's "
    "what's when's where's who's why's would"
).split()

# --- Fixed values: training defaults ---
TRAIN_PERCENT = 80          # 80/20 split
RANDOM_SPLIT_SEED = 5000    # seed of the faithful randomSplit mode
VOCAB_SIZE = 1 << 18        # CountVectorizer default vocabulary limit
MICRO_BATCH_INTERVAL = "5 seconds"
