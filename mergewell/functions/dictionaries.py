"""Fixed values of the normalization: word lists and codes that results depend on."""

LEGAL_TOKENS = (
    "inc incorporated corp corporation co company cos llc lc llp lp ltd limited pllc pc plc ltda lllp "
    "pvt private pvtltd opc praivet limitid elelpi kampni kampani "
    "sarl sas sasu sa eurl sci snc sca scop scp selarl"
).split()

FILLER_TOKENS = "the m s ms messrs sri shri shree sree and of le la les l de du des d et www com net org".split()

DBA_MARKERS = ("doing business as", "formerly known as", "also known as", "trading as", "formerly", "d b a", "dba", "f k a", "fka", "a k a", "aka")

NAME_SYNONYMS = {
    "intl": "international", "mfg": "manufacturing", "svcs": "service", "svc": "service", "services": "service", "mgmt": "management",
    "assoc": "associate", "assocs": "associate", "associates": "associate", "bros": "brothers", "ctr": "center", "centre": "center", "grp": "group",
    "hosp": "hospital", "univ": "university", "dept": "department", "natl": "national", "technologies": "tech", "technology": "tech",
    "industries": "industry", "inds": "industry", "enterprises": "enterprise", "traders": "trader", "trading": "trader", "exports": "export",
    "imports": "import", "solutions": "solution", "systems": "system", "products": "product", "partners": "partner", "holdings": "holding",
    "ventures": "venture", "consultants": "consultant", "consultancy": "consulting",
}

ADDRESS_SYNONYMS = {
    "street": "st", "str": "st", "road": "rd", "avenue": "ave", "av": "ave", "boulevard": "blvd", "bd": "blvd", "drive": "dr", "lane": "ln", "court": "ct",
    "circle": "cir", "circ": "cir", "place": "pl", "parkway": "pkwy", "pky": "pkwy", "highway": "hwy", "trail": "trl", "terrace": "ter", "terr": "ter",
    "square": "sq", "crescent": "cres", "apartment": "apt", "apts": "apt", "apartments": "apt", "suite": "ste", "floor": "fl", "flr": "fl",
    "building": "bldg", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
    "mount": "mt", "fort": "ft", "point": "pt", "junction": "jct", "expressway": "expy", "freeway": "fwy", "route": "rte",
    "near": "nr", "opposite": "opp", "village": "vlg", "vill": "vlg", "district": "dist", "distt": "dist", "taluka": "tq", "taluk": "tq", "tehsil": "tq",
    "sector": "sec", "colony": "col", "nagar": "ngr", "marg": "mrg", "cross": "crs", "main": "mn", "phase": "ph", "block": "blk", "house": "h", "hno": "h",
    "khasra": "kh", "ground": "gr", "first": "1", "second": "2", "third": "3", "fourth": "4", "fifth": "5",
    "rue": "r", "allee": "all", "impasse": "imp", "chemin": "ch", "faubourg": "fbg", "quai": "qu", "residence": "res",
}

#: What differs in France, where "st" is a saint.
ADDRESS_SYNONYMS_FRANCE = {"st": "saint", "ste": "sainte", "street": "st"}

ADDRESS_DROPPED = "null none nan na cdp township townshp twp town of the city county po box pmb no and de du des la le les d l".split()

US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky",
    "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo",
    "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny",
    "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri",
    "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa",
    "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy", "district of columbia": "dc", "puerto rico": "pr",
}

INDIA_STATES = {
    "andhra pradesh": "ap", "arunachal pradesh": "arp", "assam": "as", "bihar": "br", "chhattisgarh": "cg", "chattisgarh": "cg", "goa": "ga",
    "gujarat": "gj", "haryana": "hr", "himachal pradesh": "hp", "jharkhand": "jh", "karnataka": "ka", "kerala": "kl", "madhya pradesh": "mp",
    "maharashtra": "mh", "manipur": "mnp", "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl", "odisha": "od", "orissa": "od", "punjab": "pb",
    "rajasthan": "rj", "sikkim": "sk", "tamil nadu": "tn", "tamilnadu": "tn", "telangana": "tg", "ts": "tg", "tripura": "tr", "uttar pradesh": "up",
    "uttarakhand": "uk", "uttaranchal": "uk", "west bengal": "wb", "delhi": "dl", "jammu and kashmir": "jk", "chandigarh": "chd", "puducherry": "py",
    "pondicherry": "py",
}

FRANCE_REGIONS = {
    "auvergne rhone alpes": "ara", "bourgogne franche comte": "bfc", "bretagne": "bre", "centre val de loire": "cvl", "corse": "cor", "grand est": "ges",
    "hauts de france": "hdf", "ile de france": "idf", "normandie": "nor", "nouvelle aquitaine": "naq", "occitanie": "occ", "pays de la loire": "pdl",
    "provence alpes cote d azur": "pac",
}

REGIONS = {"us": US_STATES, "india": INDIA_STATES, "france": FRANCE_REGIONS}

#: State names in their own scripts, matched before romanization.
NATIVE_STATES = {
    "महाराष्ट्र": "mh", "नई दिल्ली": "dl", "दिल्ली": "dl", "उत्तर प्रदेश": "up", "ಕರ್ನಾಟಕ": "ka", "தமிழ்நாடு": "tn", "ગુજરાત": "gj", "পশ্চিমবঙ্গ": "wb",
    "తెలంగాణ": "tg", "हरियाणा": "hr", "राजस्थान": "rj", "കേരളം": "kl", "बिहार": "br", "मध्य प्रदेश": "mp", "ఆంధ్రప్రదేశ్": "ap", "ਪੰਜਾਬ": "pb", "ଓଡ଼ିଶା": "od",
    "उत्तराखंड": "uk", "झारखंड": "jh", "छत्तीसगढ़": "cg", "गोवा": "ga", "हिमाचल प्रदेश": "hp", "অসম": "as", "असम": "as",
}

#: Digits that stand for letters inside words.
LOOKALIKES = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}

#: The sound key: patterns first, then strings, in this order.
SOUND_PATTERNS = (("tion", "shn"), ("c([eiy])", "s$1"), ("g([eiy])", "j$1"), (r"j\b", "s"))
SOUND_STRINGS = (
    ("ph", "f"), ("sh", "s"), ("th", "t"), ("dh", "d"), ("bh", "b"), ("kh", "k"), ("gh", "g"), ("jh", "j"), ("wh", "v"), ("vh", "v"),
    ("ch", "c"), ("ck", "k"), ("c", "k"), ("q", "k"), ("x", "ks"), ("z", "s"), ("w", "v"), ("y", "i"), ("'", ""), ("d", "t"),
)
SOUND_DOUBLED = "bfgjklmnprstv"

#: Cleaning of a name in lower case, in this order: initials, web addresses, domain endings, "&", marks.
NAME_PATTERNS = (
    (r"\b([a-z])\.", "$1"), (r"\|?\s*(?:https?://)?www\.[^\s|]+", " "), (r"\.(?:com|in|net|org|co|fr|us|biz|info)\b", " "),
    ("&", " and "), ("[^a-z0-9 ]", " "),
)

#: Cleaning of an address in lower case, in this order: ordinals, marks, leading zeros.
ADDRESS_PATTERNS = ((r"(\d+)\s*(?:st|nd|rd|th)\b", "$1"), ("[^a-z0-9 ]", " "), (r"\b0+(\d)", "$1"))
