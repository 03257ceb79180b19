"""Default word lists. Every operator takes its list as an argument; these are the defaults."""

from __future__ import annotations

import glob
import os
import zipfile
from functools import cache

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover

# ---------------------------------------------------------------------------
# Apostrophe look-alikes, contractions and negation words.
# ---------------------------------------------------------------------------
APOSTROPHES = "’‘`´"

# Contractions whose expansion is not "stem + not".
IRREGULAR_CONTRACTIONS = {
    "won't": "will not",
    "can't": "cannot",
    "shan't": "shall not",
    "ain't": "is not",
}

# suffix -> (words it is expanded after, expansion)
SUFFIX_CONTRACTIONS = {
    "'s": ("it that what where how there here who", "is"),
    "'m": ("i", "am"),
    "'re": ("you they we", "are"),
    "'ve": ("i you we they", "have"),
    "'ll": ("i you he she we they", "will"),
    "'d": ("i you he she we they", "would"),
}

# Words joined to the following word by negation marking.
NEGATION_MARKERS = "not no never neither nor nothing nowhere hardly barely cannot".split()

# ---------------------------------------------------------------------------
# Negations that stay when stop words are removed.
# ---------------------------------------------------------------------------
PRESERVED_NEGATIONS = """
not no never neither nor nothing nowhere hardly barely nobody none without cannot
cant dont doesnt didnt wont isnt wasnt werent shouldnt havent hasnt hadnt
""".split()

# ---------------------------------------------------------------------------
# Negation words of the two error analyses.
# ---------------------------------------------------------------------------
NEGATION_WORDS_BASELINE = "not no never hardly barely scarcely neither nor n't without none nothing".split()
NEGATION_WORDS_TUNED = NEGATION_MARKERS

# ---------------------------------------------------------------------------
# Aspects.
# ---------------------------------------------------------------------------
ASPECT_KEYWORDS = {
    "Battery": ["battery", "battery life", "charging", "charger", "charge", "power", "drains", "charging speed"],
    "Build Quality": ["build", "quality", "material", "durable", "durability", "plastic", "metal", "design",
                      "construction"],
    "Price / Value": ["price", "cost", "expensive", "cheap", "affordable", "value", "worth", "money"],
    "Customer Support": ["support", "customer service", "service", "representative", "agent", "help", "response",
                         "refund"],
    "Delivery / Packaging": ["delivery", "shipping", "package", "packaging", "box", "courier", "arrived",
                             "delivery time"],
}

# Characters and words that end a clause.
CLAUSE_PUNCTUATION = ".!?;\n"
CONTRAST_WORDS = "but however although though whereas while yet".split()

# Substrings that file a complaint phrase under an aspect; the first aspect that matches wins.
PHRASE_ASPECTS = {
    "Battery": "battery charge charger charging power drain drains".split(),
    "Build Quality": "build quality material plastic metal durable broken cracked screen hinge case".split(),
    "Price / Value": "price cost money worth expensive cheap waste value dollar bucks".split(),
    "Customer Support": "service support representative response agent refund return warranty help email".split(),
    "Delivery / Packaging": "delivery shipping package packaging box arrived courier shipped mail late".split(),
}
GENERAL_ASPECT = "General Dissatisfaction"

# ---------------------------------------------------------------------------
# Complaints.
# ---------------------------------------------------------------------------
COMPLAINT_WORDS = """
poor bad broken defective issue problem stopped failed damaged terrible disappointing useless waste
expensive slow late missing never doesnt didnt cheap fail return refund crack cracked worst horrible
junk quit died defect fault faulty error warning wrong leak leaking broke garbage awful dreadful ripoff
unusable headache crap rubbish horrid worthless pathetic nightmare
""".split()

DOMAIN_STOP_WORDS = """
product item amazon one would get like also even bought buy really ordered order received use using used
see say know much time day days back still well way give make think could got first two take go going
many good great look looks looking put another find made ever thing things something anything nothing
everything the a an and or but in on at to for with about against between into through during before
""".split()

# (phrase, aspect) pairs recognised in a single review without any mining.
COMPLAINT_PATTERNS = [
    ("stopped working", "Battery"),
    ("drains quickly", "Battery"),
    ("wont charge", "Battery"),
    ("poor quality", "Build Quality"),
    ("cheap plastic", "Build Quality"),
    ("fell apart", "Build Quality"),
    ("broke after", "Build Quality"),
    ("waste of money", "Price / Value"),
    ("not worth", "Price / Value"),
    ("over priced", "Price / Value"),
    ("customer service", "Customer Support"),
    ("never responded", "Customer Support"),
    ("no refund", "Customer Support"),
    ("damaged box", "Delivery / Packaging"),
    ("late delivery", "Delivery / Packaging"),
    ("arrived broken", "Delivery / Packaging"),
]

# ---------------------------------------------------------------------------
# Scoring guardrail, import heuristic and upload column names.
# ---------------------------------------------------------------------------
GUARDRAIL_NEGATIVE = [
    "would not buy again", "wouldn't buy again", "do not recommend", "don't recommend", "does not work",
    "doesn't work", "not worth", "never buy", "hate", "terrible", "awful", "worst", "broken", "useless",
]
GUARDRAIL_POSITIVE = [
    "buy again", "love", "excellent", "perfect", "amazing", "great", "recommend", "works perfectly",
]
IMPORT_POSITIVE_WORDS = "great love amazing perfect good best".split()

UPLOAD_ROLES = {
    "text": "review text content body comment review_text".split(),
    "rating": "rating score stars star_rating".split(),
    "title": "title summary headline".split(),
}


@cache
def _english() -> tuple[str, ...]:
    if SparkContext._active_spark_context is not None:
        return tuple(StopWordsRemover.loadDefaultStopWords("english"))
    # Without a session, read the same resource from the MLlib jar of this installation.
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    jar = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))[0]
    with zipfile.ZipFile(jar) as archive:
        text = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
    return tuple(line for line in text.splitlines() if line)


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return list(_english())


def sentiment_stop_words(preserved: list[str] = PRESERVED_NEGATIONS) -> list[str]:
    """English stop words without the negations that carry sentiment."""
    keep = set(preserved)
    return [word for word in english_stop_words() if word not in keep]


def complaint_stop_words(domain: list[str] = DOMAIN_STOP_WORDS) -> list[str]:
    """English stop words plus conversational fillers."""
    return sorted(set(english_stop_words()) | set(domain))
