"""Fixed values. They decide which tokens come out, so they have to stay exactly as they are."""

# The characters that become a space.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
EXTRA_SYMBOLS = "\n”“’‘€´…"
LEGACY_EXTRA_SYMBOLS = "\n”“’"

# Links (a run of h/t/p letters, an optional s, a colon) and digits.
LINK_PATTERN = r"[hHtTpP]+[sS]?:[A-Za-z0-9-#_./]+"
NUMBER_PATTERN = r"\p{Nd}+"
BEYOND_BMP_PATTERN = r"[\x{10000}-\x{10FFFF}]"

# The white space that is stripped from the ends of a token (all of it but the space itself,
# which separates tokens).
STRIPPED_SPACE = r"[\t-\r\x1c-\x1f\x{85}\x{a0}\p{Z}]"

# Emoji by polarity. The clapping hands are two code points.
POSITIVE_EMOJI = ["👍", "😀", "💪", "😎", "👌", "😁", "😃", "😄", "😊", "😋", "😍", "😻", "🤗", "👏🏻", "😘", "🎉", "💗", "🔝", "😉"]
NEGATIVE_EMOJI = ["👎", "😒", "😖", "😠", "😡", "😤", "😨", "😱", "😳", "😬", "😞", "🤐", "😕", "😢"]
NEUTRAL_EMOJI = ["😔", "😴", "😂", "😅", "😆", "😓"]
POSITIVE_TOKEN = "positiveemoji"
NEGATIVE_TOKEN = "negativeemoji"

# Stop words on top of the language's list, and words that must be kept.
CUSTOM_STOP_WORDS = ["http", "www", "per", "che", "con", "era", "del", "della", "tutto", "come", "ecc", "etc", "il", "li", "un", "una"]
KEPT_WORDS = ["non", "ma", "stato", "personale", "molto", "solo", "quanto"]

# Fixed value: tokens have to be shorter than this.
TOKEN_LENGTH_LIMIT = 16

# The base list of Italian stop words. Joined prepositions and verb forms follow from the rules below.
PLAIN_STOP_WORDS = (
    "ad con da di in su per tra contro io tu lui lei noi voi loro mio mia miei mie tuo tua tuoi tue suo sua suoi sue "
    "nostro nostra nostri nostre vostro vostra vostri vostre mi ti ci vi lo la li le gli ne il un uno una ma ed se "
    "perché anche come dov dove che chi cui non più quale quanto quanti quanta quante quello quelli quella quelle "
    "questo questi questa queste si tutto tutti a c e i l o"
).split()
# Prepositions with an article: stem and article, but "con" has two forms only.
ARTICLES = "l llo i gli ll gl lla lle".split()
JOINED_PREPOSITIONS = [s + a for s in ("a", "da", "de", "ne", "su") for a in ARTICLES] + ["col", "coi"]
# To have, to be, to do, to stay: tenses with regular endings by stem, then forms without a rule.
FUTURE = "ò ai à emo ete anno ei esti ebbe emmo este ebbero".split()
IMPERFECT = "o i a amo ate ano".split()
TENSES = [
    (("avr", "sar", "far", "star"), FUTURE),
    (("avev", "facev", "stav"), IMPERFECT),
    (("av", "fac", "st"), "esti emmo este essi esse essimo essero".split()),
]
OTHER_VERB_FORMS = (
    "ho hai ha abbiamo avete hanno abbia abbiate abbiano ebbi ebbe ebbero avendo avuto avuta avuti avute "
    "sono sei è siamo siete sia siate siano ero eri era eravamo eravate erano "
    "fui fosti fu fummo foste furono fossi fosse fossimo fossero essendo "
    "faccio fai facciamo fanno faccia facciate facciano feci fece fecero facendo "
    "sto stai sta stiamo stanno stia stiate stiano stetti stette stettero stando"
).split()
BASE_STOP_WORDS = [
    *PLAIN_STOP_WORDS,
    *JOINED_PREPOSITIONS,
    *(stem + ending for stems, endings in TENSES for stem in stems for ending in endings),
    *OTHER_VERB_FORMS,
]

# Words of the fixtures that stand in for emoji in the emoji queries, as the texts hold none.
EMOJI_STAND_INS = [(" le ", " 👍 "), (" que ", " 👏🏻 "), (" der ", " 👎 "), (" the ", " 😂 "), (" de ", " 😡😍 "), (" et ", " 🚀 ")]
