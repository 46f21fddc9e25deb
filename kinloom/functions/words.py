"""Word lists and name tables."""

# Legal forms that end a business name; longer ones before those they contain.
LEGAL_FORMS = (
    "public limited company", "limited liability company", "limited liability partnership", "joint stock company",
    "private limited", "pvt limited", "pvt ltd", "pte ltd", "pty ltd", "co ltd",
    "sociedad anonima", "societe anonyme", "societa a responsabilita limitata", "sociedad de responsabilidad limitada",
    "incorporated", "corporation", "limited", "company", "corp", "inc", "ltd", "llc", "llp", "plc",
    "gmbh", "ag", "sa", "sarl", "bv", "nv", "spa", "srl", "ab", "oy", "as", "co", "cie",
)

# The code that each name of a country stands for.
COUNTRY_CODES = {
    "united states": "us", "united states of america": "us", "usa": "us", "u.s.": "us", "u.s.a.": "us", "us": "us",
    "india": "in", "ind": "in", "in": "in",
    "france": "fr", "fra": "fr", "fr": "fr",
    "germany": "de", "deutschland": "de", "deu": "de", "ger": "de", "de": "de",
    "united kingdom": "gb", "great britain": "gb", "uk": "gb", "gbr": "gb", "gb": "gb",
    "canada": "ca", "can": "ca", "ca": "ca",
    "australia": "au", "aus": "au", "au": "au",
    "japan": "jp", "jpn": "jp", "jp": "jp",
    "sweden": "se", "sverige": "se", "swe": "se", "se": "se",
    "singapore": "sg", "sgp": "sg", "sg": "sg",
    "brazil": "br", "brasil": "br", "bra": "br", "br": "br",
    "italy": "it", "italia": "it", "ita": "it", "it": "it",
    "spain": "es", "espana": "es", "esp": "es", "es": "es",
    "netherlands": "nl", "holland": "nl", "nld": "nl", "nl": "nl",
    "china": "cn", "prc": "cn", "chn": "cn", "cn": "cn",
    "mexico": "mx", "mex": "mx", "mx": "mx",
}

# Address words too common to block on.
ADDRESS_STOPWORDS = (
    "st", "street", "rd", "road", "ave", "avenue", "blvd", "boulevard", "dr", "drive", "ln", "lane", "way",
    "ct", "court", "pl", "place", "sq", "square", "ste", "suite", "fl", "floor", "apt", "apartment", "unit",
    "box", "po", "pobox", "bldg", "building", "hwy", "highway", "expressway", "route", "rte", "pkwy", "parkway",
    "north", "south", "east", "west", "n", "s", "e", "w", "no", "nr", "near", "opp", "opposite", "behind", "beside",
)

# Name words too common to block on.
NAME_STOPWORDS = ("the", "and", "for", "of", "in", "to", "at", "a", "an", "by", "with", "from", "on")

# What counts as missing, in cells that are classified and in cells that are normalised.
NULL_CELLS = ("<NA>", "NaN", "null", "NULL", "None")
NULL_WORDS = ("nan", "null", "none", "<na>")
