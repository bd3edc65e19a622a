"""Fixed word lists."""

from __future__ import annotations

# The English stop words of Spark's StopWordsRemover.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're
i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
who's why's would
""".split()

# Punctuation tokens added to the stop words.
PUNCTUATION_STOP_WORDS = [".", ",", ":", "?", "'s", ";", "'", '"', "''"]

# Irregular English forms and their lemmas.
IRREGULAR_LEMMAS = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be", "been": "be", "being": "be",
    "has": "have", "had": "have", "having": "have",
    "does": "do", "did": "do", "done": "do", "doing": "do",
    "an": "a", "these": "this", "those": "that",
    "went": "go", "gone": "go", "men": "man", "women": "woman", "children": "child", "feet": "foot", "mice": "mouse",
}

# Verbs that may stand between the two arguments of an open triple.
RELATION_VERBS = ["is", "are", "was", "were", "be", "has", "have", "had", "est", "ist", "es", "son", "sind", "sont"]

# A small thesaurus (word, part of speech, synonym).
SYNSETS = [
    ("was", "v", "existed"), ("was", "v", "lived"), ("are", "v", "exist"), ("are", "n", "hectare"),
    ("is", "v", "exists"), ("is", "v", "equals"), ("be", "v", "exist"), ("be", "n", "beryllium"),
    ("this", "r", "thus"), ("that", "r", "so"), ("that", "r", "such"), ("at", "n", "astatine"),
    ("as", "r", "equally"), ("as", "r", "every bit"), ("as", "n", "arsenic"), ("in", "n", "inch"),
    ("in", "n", "indium"), ("in", "a", "inward"), ("in", "r", "inside"), ("ha", "n", "hectare"),
    ("he", "n", "helium"), ("he", "n", "atomic number 2"), ("or", "n", "operating room"), ("on", "a", "active"),
    ("on", "r", "onward"), ("a", "n", "angstrom"), ("a", "n", "ampere"), ("the", "r", "that much"),
]

# A small gazetteer (word, tag).
GAZETTEER = [
    ("Apache", "ORGANIZATION"), ("Stteen", "PERSON"), ("Erachtz", "PERSON"), ("Orre", "LOCATION"),
    ("Thsterhe", "LOCATION"), ("Eaea", "PERSON"), ("License", "MISC"), ("General", "MISC"), ("Public", "MISC"),
]

# Words that belong to the domain whatever tag they carry otherwise.
DOMAIN_WORDS = ["the", "thatin", "orantion", "hehely", "license", "orre"]
