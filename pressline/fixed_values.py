"""Word lists, lookup tables, patterns and formats.

They decide which rows count as foreign, which URL is an article and which
category a page gets, so they have to hold exactly these entries for results to
agree.  Nothing here is read directly by the operators: ``params`` wraps the
values in parameter objects that a caller can replace.
"""

# --- categories ---------------------------------------------------------------
DEFAULT_CATEGORY = "Novice"

STANDARD_CATEGORIES = [
    "Novice", "Društvo", "Monty Dayton", "Ex Yu", "Hrvatska", "Svijet",
    "Kolumne", "Sport", "Religija", "Kultura", "Gospodarstvo", "Crna kronika",
    "Lifestyle", "Politika", "Dijaspora", "Zdravlje", "Obrazovanje",
    "Tehnologija",
]

# URL path segment -> category, first match wins
URL_CATEGORIES = [
    ("aktualno", "Novice"), ("drustvo", "Društvo"),
    ("monty-dayton", "Monty Dayton"), ("ex-yu", "Ex Yu"),
    ("perecija", "Hrvatska"), ("svijet", "Svijet"), ("kolumne", "Kolumne"),
    ("sport", "Sport"), ("religija", "Religija"), ("vjera", "Religija"),
    ("crkva", "Religija"), ("kultura", "Kultura"), ("umjetnost", "Kultura"),
    ("gospodarstvo", "Gospodarstvo"), ("ekonomija", "Gospodarstvo"),
    ("financije", "Gospodarstvo"), ("crna-kronika", "Crna kronika"),
    ("crna", "Crna kronika"), ("kriminal", "Crna kronika"),
    ("lifestyle", "Lifestyle"), ("zivot", "Lifestyle"),
    ("zdravlje", "Zdravlje"), ("medicina", "Zdravlje"),
    ("politika", "Politika"), ("izbori", "Politika"),
    ("dijaspora", "Dijaspora"), ("iseljenistvo", "Dijaspora"),
    ("obrazovanje", "Obrazovanje"), ("skola", "Obrazovanje"),
    ("fakultet", "Obrazovanje"), ("tehnologija", "Tehnologija"),
    ("tech", "Tehnologija"),
]

# keyword groups looked for anywhere in the URL when no segment matched
URL_KEYWORDS = [
    (["nogomet", "kosarka", "rukomet", "tenis", "olimpij", "sport"], "Sport"),
    (["crkva", "religij", "vjera", "biskup", "papa", "islam", "dzamij"], "Religija"),
    (["politika", "izbori", "stranka", "sabor", "vlada", "ministar", "predsjednik"], "Politika"),
    (["ekonomij", "gospodar", "financij", "biznis", "trzist", "novac"], "Gospodarstvo"),
    (["kriminal", "ubojstv", "nesrec", "sudjen", "zatvor", "policij", "uhicen"], "Crna kronika"),
    (["dijaspor", "iseljenici", "iseljenistvo", "inozemst"], "Dijaspora"),
]

# strict variant: only these segments, no default
URL_CATEGORIES_STRICT = [
    ("novice", "Novice"), ("drustvo", "Društvo"), ("politika", "Politika"),
    ("svijet", "Svijet"), ("sport", "Sport"), ("kultura", "Kultura"),
    ("gospodarstvo", "Gospodarstvo"), ("lifestyle", "Lifestyle"),
    ("tehnologija", "Tehnologija"), ("zdravlje", "Zdravlje"),
]

# written category name -> category: exact match first, then substring
NAME_CATEGORIES = [
    ("aktualno", "Novice"), ("aktuelno", "Novice"), ("politika", "Politika"),
    ("vijesti", "Novice"), ("društvo", "Društvo"), ("drustvo", "Društvo"),
    ("hrvati", "Hrvatska"), ("hrvatska", "Hrvatska"), ("regija", "Ex Yu"),
    ("regioni", "Ex Yu"), ("region", "Ex Yu"), ("bih", "Novice"),
    ("bosna", "Novice"), ("hercegovina", "Novice"), ("život", "Lifestyle"),
    ("zivot", "Lifestyle"), ("kultura", "Kultura"), ("umjetnost", "Kultura"),
    ("kolumna", "Kolumne"), ("komentar", "Kolumne"), ("monty", "Monty Dayton"),
    ("dayton", "Monty Dayton"), ("sport", "Sport"), ("nogomet", "Sport"),
    ("košarka", "Sport"), ("rukomet", "Sport"), ("tenis", "Sport"),
    ("vjera", "Religija"), ("religija", "Religija"), ("crkva", "Religija"),
    ("gospodarstvo", "Gospodarstvo"), ("ekonomija", "Gospodarstvo"),
    ("biznis", "Gospodarstvo"), ("financije", "Gospodarstvo"),
    ("crna kronika", "Crna kronika"), ("crna", "Crna kronika"),
    ("kriminal", "Crna kronika"), ("lifestyle", "Lifestyle"),
    ("stil života", "Lifestyle"), ("zdravlje", "Zdravlje"),
    ("medicina", "Zdravlje"), ("dijaspora", "Dijaspora"),
    ("iseljenistvo", "Dijaspora"), ("iseljenici", "Dijaspora"),
    ("obrazovanje", "Obrazovanje"), ("škola", "Obrazovanje"),
    ("fakultet", "Obrazovanje"), ("tehnologija", "Tehnologija"),
    ("tech", "Tehnologija"), ("it", "Tehnologija"),
]

# word stems -> category, first group wins
STEM_CATEGORIES = [
    (["vijest", "novost", "aktualn", "dnevn", "najnovij"], "Novice"),
    (["polit", "stranka", "vlada", "predsjednik", "ministar", "izbor",
      "glasanj", "glasov", "parlament"], "Politika"),
    (["hrvat", "split", "zagreb", "dalmat", "slavonij"], "Hrvatska"),
    (["bosn", "hercegovin", "mostar", "sarajev", "banja", "luka"], "Novice"),
    (["srb", "crn", "gora", "makedon", "sever", "macedon", "kosov", "albanij"], "Ex Yu"),
    (["svijet", "global", "međunarod", "eu", "europ", "amerika", "sad",
      "kina", "rusij"], "Svijet"),
    (["dijas", "iseljeni"], "Dijaspora"),
    (["društv", "soci", "zajedn"], "Društvo"),
    (["sport", "nogomet", "košark", "rukomet", "tenis", "olimp"], "Sport"),
    (["vjer", "relig", "crkv", "katol", "pravosl", "islam"], "Religija"),
    (["ekonom", "gospodar", "financ", "biznis", "tržišt", "novac"], "Gospodarstvo"),
    (["krim", "uboj", "nesreć", "sud", "zatvor", "polic", "uhić"], "Crna kronika"),
    (["život", "stil", "moda", "ljepot", "trend", "brak", "obitelj"], "Lifestyle"),
    (["zdrav", "medicin", "liječn", "bolesn", "virus", "bolnica", "covid"], "Zdravlje"),
    (["obraz", "škol", "fakult", "znanj", "učen", "student"], "Obrazovanje"),
    (["kult", "umjetn", "film", "književ", "glazb", "kazališ"], "Kultura"),
    (["teh", "digital", "kompjut", "internet", "mobitel", "gadget"], "Tehnologija"),
    (["kolumn", "komentar", "miš", "osvrt", "analiz"], "Kolumne"),
    (["monty", "dayton"], "Monty Dayton"),
]

# title keywords -> category
TITLE_CATEGORIES = [
    (["nogomet", "košark", "nba", "liga", "utakmic", "pobjed", "poraz",
      "igra", "trener"], "Sport"),
    (["crkv", "papa", "biskup", "religij", "vjera", "župnik", "misa",
      "hodočašć"], "Religija"),
    (["ekonomij", "gospodar", "financij", "novac", "cijene", "inflacij",
      "tečaj"], "Gospodarstvo"),
    (["ubojstv", "zločin", "kriminal", "policij", "uhićen", "sud", "zatvor"],
     "Crna kronika"),
    (["obitelj", "brak", "djeca", "život", "obrazovan", "škola", "fakultet"],
     "Društvo"),
]

# category name -> listing path segment
LISTING_SEGMENTS = [
    ("Novice", "aktualno"), ("Društvo", "drustvo"),
    ("Monty Dayton", "monty-dayton"), ("Ex Yu", "ex-yu"),
    ("Hrvatska", "perecija"), ("Svijet", "svijet"), ("Kolumne", "kolumne"),
    ("Sport", "sport"), ("Religija", "religija"), ("Kultura", "kultura"),
    ("Gospodarstvo", "gospodarstvo"), ("Crna kronika", "crna-kronika"),
    ("Lifestyle", "lifestyle"), ("Politika", "politika"),
    ("Dijaspora", "dijaspora"), ("Zdravlje", "zdravlje"),
    ("Obrazovanje", "obrazovanje"), ("Tehnologija", "tech"),
]

# --- foreign-language lexicon -------------------------------------------------
INDICATORS_A = [
    "nella", "dello", "della", "degli", "delle", "nell", "italiano", "italia",
    "civiltà", "specchio", "allo", "epicentro", "declino", "femminicidio",
    "una settimana", "due studentesse", "questa", "questo", "questi", "queste",
    "come", "sono", "dove", "oggi", "paese", "terra", "essere", "alla",
    "legge", "caso", "più", "società", "cultura", "donne", "uomini", "volta",
    "ancora", "sempre", "anche", "quando", "perché", "senza", "tutto", "tutti",
    "ogni", "altro", "altra", "altri", "altre", "quello", "quella", "quelli",
    "quelle",
]

INDICATORS_B = [
    "the", "that", "this", "these", "those", "there", "they", "them", "their",
    "because", "when", "what", "where", "which", "who", "whom", "whose", "why",
    "how", "would", "could", "should", "must", "might", "may", "had", "been",
    "have", "has", "declared", "undesirable", "persona non grata", "too hot",
    "dressed as", "came", "forgot", "woman", "women", "just", "didn", "wasn",
    "doesn", "aren", "don", "looking", "asked", "rolled", "over", "know",
    "knows", "knew", "known", "about", "above", "across", "after", "against",
    "along", "around", "before", "behind", "below", "beneath", "beside",
    "between", "beyond", "during", "except", "inside", "outside", "through",
    "under", "underneath", "helicopter", "crashes", "river", "york", "james",
    "trump", "fears", "will", "martial", "law", "elections", "rig", "move",
    "desperate", "men", "germany", "bans", "entry", "austria", "considering",
    "same", "joint", "mile", "killing", "aboard",
]

PHRASES_A = [
    "nella terra di", "in una settimana", "il paese si confronta",
    "la legge per quanto", "la percezione della donna", "il caso di",
    "questi episodi non sono", "civiltà antica", "pur essendo",
]

PHRASES_B = [
    "it's not that", "they just got", "she came as", "in this part of",
    "what matters is that", "she wasn't here to", "no one asked",
    "this column contains", "if you're offended", "may contain traces of",
    "helicopter crashed", "new york city", "killing all", "aboard",
    "hudson river", "tourist helicopter", "mayor eric adams",
    "declared martial law", "james carville fears", "trump will",
    "rig the elections", "let's call it", "move of exposed", "desperate men",
    "austria considering", "germany bans", "no joint for mile",
]

TITLE_KEYWORDS = [
    "helicopter", "crashes", "new york", "hudson", "river", "james",
    "carville", "trump", "martial", "law", "killing", "aboard",
    "no joint for", "let's call", "move of",
]

TITLE_REJECTS = [
    "helicopter", "crashes", "new york", "hudson", "river", "killing",
    "aboard", "james", "carville", "trump", "fears", "martial", "law",
    "elections", "let's", "call", "move", "desperate", "men", "germany",
    "bans", "entry", "austria", "considering", "same", "joint", "mile",
]

TITLE_STARTERS = [
    "the ", "a ", "an ", "this ", "that ", "these ", "those ", "helicopter",
    "james", "trump",
]

HTML_TITLE_TERMS_A = [
    "italia", "dello", "della", "specchio", "femminicidio", "civiltà",
    "epicentro",
]

HTML_TITLE_TERMS_B = [
    "too hot", "declared", "undesirable", "persona non grata", "helicopter",
    "crashes", "new york", "hudson", "killing", "james", "carville", "trump",
    "martial", "law", "elections",
]

BLACKLISTED_TERMS = [
    "italia allo specchio", "femminicidio", "civilta nell", "epicentro dell",
    "nella terra", "della", "dello", "degli", "delle", "nell", "italiano",
    "italia", "too hot to be", "declared undesirable", "persona non grata",
    "dressed as", "in english", "english version", "new york", "hudson river",
    "helicopter crashes", "james carville", "trump will declare",
    "martial law", "rig the elections", "lets call it", "move of exposed",
    "desperate men", "germany bans", "no joint for mile", "helicopter",
    "crashes", "in-english", "english-version", "italian-version",
]

BLACKLISTED_SUBTITLES = [
    "Na Diplomatskom forumu u Antaliji",
    "Bošnjačka politika svjesna je da",
    "Kažu neki da je Trump Neron",
]

ALLOWED_LANGS = ["hr", "bs", "sr"]
TOKEN_STRIP_CHARS = ".,!?:;-—\"'()"

# --- URL patterns -------------------------------------------------------------
LANG_PATHS = ["/en/", "/eng/", "/english/", "/it/", "/ita/", "/italian/"]

FOREIGN_URL_PATTERNS = [
    "/en/", "/eng/", "/english/", "/in-english/", "in-english", "/it/",
    "/ita/", "/italian/", "/italiano/", "italia-allo-specchio",
    "femminicidio", "civiltà-nell", "epicentro-dell", "too-hot-to-be",
    "declared-undesirable", "persona-non-grata", "helicopter-crashes",
    "hudson-river", "new-york", "james-carville", "trump-will", "martial-law",
    "lets-call-it", "move-of-exposed", "desperate-men", "germany-bans",
    "no-joint-for-mile",
]

ARTICLE_INCLUDES = [
    r"/\d{4}/\d{2}/[^/]+/$", r"\.html?$", r"/[^/]+-\d+/$", r"/article/",
    r"/post/", r"/story/", r"/news/",
]

ARTICLE_EXCLUDES = [
    r"/page/\d+/$", r"/category/", r"/tag/", r"/author/", r"/search/",
    r"/feed/", r"\.xml$", r"\.pdf$", r"/wp-",
]

ARTICLE_SEGMENTS = ["2023/", "2024/", "2022/", ".html"]

WELL_KNOWN_PATHS = [
    "/feed/", "/comments/feed/", "/wp-json/", "/wp-json/wp/v2/posts",
    "/xmlrpc.php", "/wp-login.php", "/wp-admin/", "/wp-content/uploads/",
    "/category/", "/tag/", "/author/", "/search/", "/page/1/",
]

COMMON_CATEGORY_SLUGS = [
    "novice", "drustvo", "politika", "svijet", "sport", "kultura",
    "gospodarstvo", "lifestyle", "tehnologija", "zdravlje", "obrazovanje",
]
CATEGORY_TEMPLATES = ["{base}/category/{term}/", "{base}/kategorija/{term}/"]

SEARCH_TERMS = (
    ["a", "e", "i", "o", "u"]
    + [str(y) for y in range(2012, 2026)]
    + ["bosna", "hercegovina", "sarajevo", "mostar", "banja", "luka",
       "hrvatska", "srbija", "slovenija", "crna", "gora", "politika", "sport",
       "kultura", "gospodarstvo"]
)
SEARCH_TEMPLATES = [
    "{base}/?s={term}", "{base}/search/{term}/", "{base}/search/?q={term}",
]

# month archive URL shapes: {m2} zero-padded month, {m} bare month
ARCHIVE_SHAPES = [
    "{base}/{y}/{m2}/", "{base}/archive/{y}/{m2}/",
    "{base}/archives/{y}/{m2}/", "{base}/{y}/{m}/",
]

# --- dates --------------------------------------------------------------------
MONTHS_BASIC = [
    ("siječnja", 1), ("veljače", 2), ("ožujka", 3), ("travnja", 4),
    ("svibnja", 5), ("lipnja", 6), ("srpnja", 7), ("kolovoza", 8),
    ("rujna", 9), ("listopada", 10), ("studenog", 11), ("prosinca", 12),
]

MONTHS_BOTH_FORMS = [
    ("siječnja", 1), ("siječanj", 1), ("veljače", 2), ("veljača", 2),
    ("ožujka", 3), ("ožujak", 3), ("travnja", 4), ("travanj", 4),
    ("svibnja", 5), ("svibanj", 5), ("lipnja", 6), ("lipanj", 6),
    ("srpnja", 7), ("srpanj", 7), ("kolovoza", 8), ("kolovoz", 8),
    ("rujna", 9), ("rujan", 9), ("listopada", 10), ("listopad", 10),
    ("studenog", 11), ("studeni", 11), ("prosinca", 12), ("prosinac", 12),
]

# --- record text --------------------------------------------------------------
RECORD_MARKER = "<***>"
RECORD_KEYS = [
    ("source", "NOVINA"), ("date", "DATUM"), ("category", "RUBRIKA"),
    ("overline", "NADNASLOV"), ("title", "NASLOV"), ("subtitle", "PODNASLOV"),
    ("url", "STRANA"), ("author", "AUTOR(I)"),
]
MISSING = "N/A"

# --- page text rules ----------------------------------------------------------
SUBTITLE_REJECTS = [
    r"\b(kazao je|rekao je|izjavio je|naglasio je|poručio je|zaključio je)\b",
    r"\b(jučer|danas|sutra)\b",
    r"\b(međutim|ipak|stoga|zato)\b",
    r"^[A-Z][a-z]+ [A-Z][a-z]+ je",
    r"^[A-Z][a-z]+, \d{1,2}\. [a-z]+ \d{4}\.",
]
BODY_SKIP_TERMS = [
    "oglas", "advertisement", "reklama", "sponsored",
    "više na našoj facebook stranici", "pratite nas na",
]
BODY_SKIP_CLASSES = [
    "share", "social", "comment", "widget", "sidebar", "footer", "nav",
]
FALLBACK_SKIP_CLASSES = ["footer", "sidebar", "comment", "widget", "breadcrumb"]
CASCADE_SKIP_TERMS = ["oglas", "advertisement", "share this", "pratite nas"]
# cut marks of the alternative body; "{name}" is the site's short name
STOP_PHRASES = [
    "Pratite nas na", "Pratite {name}", "Copyright", "All rights reserved",
    "Sva prava zadržana", "Oglas", "OGLAS", "Advertising",
]
BYLINE_PREFIX = r"^(By|Autor|Piše)"
BYLINE_IN_TEXT = r"(autor|piše|by)"

# lines of the report on a combined archive, filled in by format
REPORT_LINES = (
    "=== {NAME} REPORT ===",
    "Generated: %s",
    "",
    "SUMMARY:",
    "- Total input files processed: %d",
    "- Total articles found: %d",
    "- Unique articles saved: %d",
    "- Duplicate articles removed: %d",
    "",
    "OUTPUT:",
    "- Combined articles saved to: %s",
    "",
    "COMPLETION RATE:",
    "- Articles successfully processed: %d / %d",
    "- Success rate: %.2f%%",
    "",
    "This report was generated automatically by {name}.",
)
