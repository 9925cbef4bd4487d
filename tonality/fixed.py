"""Fixed values that must equal the published ones for right results.

Everything here is a constant; no logic lives in this module.
"""

# --- fixed values: NLTK English stop-word list (179 words, corpus order) ---
# The classifier chain removes these words (a caller may pass another list).
NLTK_ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "that'll", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just",
    "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re",
    "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
)

# --- fixed values: classifier chain parameters ---
HASHING_NUM_FEATURES = 262144        # 2^18 hashed term buckets
IDF_MIN_DOC_FREQ = 5                 # terms in fewer documents get weight 0
LR_MAX_ITER = 10
LR_REG_PARAM = 0.001
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 12345

# --- fixed values: rule-based lexicon scoring constants (Hutto & Gilbert 2014) ---
BOOSTER_DAMPING = (1.0, 0.95, 0.9)   # booster weight at distance 1, 2, 3
CAPS_INCREMENT = 0.733               # all-caps emphasis when the sentence mixes case
NEGATION_SCALAR = -0.74              # valence multiplier after a negating word
BUT_BEFORE = 0.5                     # weight of words before the first "but"
BUT_AFTER = 1.5                      # weight of words after the first "but"
EXCLAMATION_WEIGHT = 0.292           # per "!" in the sentence
EXCLAMATION_MAX = 4                  # at most this many "!" count
QUESTION_WEIGHT = 0.18               # per "?" when there are 2 or 3
QUESTION_MANY = 0.96                 # when there are more than 3 "?"
NORMALIZATION_ALPHA = 15.0           # compound = s / sqrt(s*s + alpha)
NEUTRAL_BAND = 0.05                  # |compound| below this counts as neutral
FACTOR_DAMPING = (1.0, 0.5, 0.0)     # share of a factor's excess over 1 at distance 1, 2, 3
NEGATION_SUFFIX = "n't"              # a word containing this negates
CONTRAST_WORD = "but"

# --- fixed values: phrases of the published rules ---
# (phrase, valence, incr, neg, factor, near): idioms with a valence of their own, boosters
# of two words, "never so / this" as a factor, units without any role, and "least",
# which negates the next word only.
PUBLISHED_PHRASES = (
    ("the shit", 3.0, None, False, None, False),
    ("the bomb", 3.0, None, False, None, False),
    ("bad ass", 1.5, None, False, None, False),
    ("yeah right", -2.0, None, False, None, False),
    ("cut the mustard", 2.0, None, False, None, False),
    ("kiss of death", -1.5, None, False, None, False),
    ("hand to mouth", -2.0, None, False, None, False),
    ("kind of", None, -0.293, False, None, False),
    ("sort of", None, -0.293, False, None, False),
    ("never so", None, None, False, 1.5, False),
    ("never this", None, None, False, 1.5, False),
    ("without doubt", None, None, False, None, False),
    ("at least", None, None, False, None, False),
    ("very least", None, None, False, None, False),
    ("least", None, None, False, None, True),
)

# --- fixed values: learnt sentence boundaries (Kiss & Strunk 2006) ---
PERIOD_GIVEN_ABBREVIATION = 0.99     # assumed rate of a final period in an abbreviation
ABBREVIATION_SCORE = 0.3             # least score of an abbreviation
STARTER_SCORE = 30.0                 # least log-likelihood ratio of a sentence starter
COLLOCATION_SCORE = 7.88             # least log-likelihood ratio of a pair around a period

# ASCII punctuation stripped from token edges (Python's string.punctuation).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Spark's default English stop words, in Spark's order.
ENGLISH_STOP_WORDS: tuple[str, ...] = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split())
