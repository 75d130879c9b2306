"""The words that race labels are made of, by kind. Patterns of Java's regular expressions on text in lower case."""

from __future__ import annotations

# Fixed values from here on: what results depend on, in natural order. A pair is a pattern and the subcategory it names.

#: Marks and words that join; those that set groups side by side.
MARK = r"[/,;&():\-–—]"
JOIN_WORDS = r"and/or|or|and"
SIDE_BY_SIDE = ["or", "and", "and/or", "/", ",", "&", ";"]
DASHES = [":", "-", "–", "—"]

#: Middle Eastern and North African groups, what may qualify them and what may follow.
MENA_TERMS = [
    (r"(?:white\s+)?(?:middle|mid)[\s-]*e{1,2}ast(?:ern)?", "middle_eastern"),
    (r"(?:white\s+)?(?:north[\s-]*afric(?:a|an)|maghreb)", "north_african"),
    (r"(?:white\s+)?(?:arabian\s+peninsula|arab(?:ic|ian)?(?:[\s-]+american)?)", "middle_eastern_arab"),
    (r"(?:white\s+)?(?:persian|iranian)", "middle_eastern_persian"),
    (r"(?:white\s+)?mena", "middle_eastern_north_african"),
]
MENA_JOIN = r"(?:\s*(?:/{1,2}|,|&|:|\()\s*|\s+(?:or|and/or|and)\s+|\s*,\s*(?:or|and)\s+|\s+)"
MENA_BEFORE = r"(?:(?:white|wh)(?:\s*\((?:w|wt)\))?\s*(?:[\-:–—(]\s*|\s+))?"
MENA_AFTER = r"\s*(?:\(\s*mena\s*\)|\))?(?:[\s-]*(?:\(na\)\s*)?(?:heritage|hertage|her|h\.?|descent|origins?|ancestry|ethnicity))?(?:\s*,?\s*n\s*\(%\))?\s*"

#: American Indian or Alaska Native.
AIAN = {
    "name": r"american\s+indians?|am(?:er|c)?\s+indians?|amer\s+ind|alaskan?\s*natives?|native\s+alaskans?|native\s+americans?|(?:north|south|central)\s+american\s+indians?|first\s+nations?|inuits?|metis|amerindians?|eskimos?|(?:white\s+mountain\s+|san\s+carlos\s+)?apaches?|navajos?|hopis?|zunis?|yupik|inupiat|blackfeet|mayans?|mayas?|aztecs?|quechuas?|aymaras?|guaranis?|xavante|kaingang|kaigang",
    "indigenous": r"indigenous|aboriginals?|aborigines?",
    "native": r"natives?",
    "continent": r"(?:north|south|central|latin)\s+americ(?:a|an|ans)|the\s+americas|americas|americ(?:an|ans)",
    "country": r"canad(?:a|ian|ians)|alaskan?|brazil(?:ian|ians)?|mexic(?:o|an|ans)|guatemal(?:a|an|ans)|peru(?:vian|vians)?|bolivi(?:a|an|ans)|ecuador(?:ian|ians)?|chile(?:an|ans)?|colombi(?:a|an|ans)",
    "direction": r"north|south|central",
    "abbrev": r"amer|am|amc|ind|al|alk|n|nat|ai|an|amin|alaska",
    "tribe": r"nations?|tribes?|tribal|bands?|members?|communit(?:y|ies)",
    "filler": r"peoples?|persons?|only|e\s*g|i\s*e|from|of|non\s+status|ethnicity|descent|origins?|ancestry",
    "join": JOIN_WORDS,
}
AIAN_GLOSS = r"\s*\(\s*(?:amer|am|amc|ind|al|alk|n|nat|ai|an|amin|alaska|alk\s+n|amer\s+ind)\s*\)\s*"

#: Native Hawaiian or Pacific Islander.
HAWAIIAN = r"hawaiians?|hawaiins?|hawiians?|hawains?|hawaians?|haiwaiians?"
PACIFIC_WORD = r"(?:(?:other|oth)\s+)?(?:pacific|pacif|pac)"
PACIFIC_GROUP = rf"{PACIFIC_WORD}\s+(?:islanders?|islands?|isles?|peoples?)"
NHPI_SUBS = [(rf"native\s+hawaii|{HAWAIIAN}", "native_hawaiian"), (r"samoans?", "samoan"), (r"tongans?", "tongan"), (r"fijians?", "fijian"), (r"chamorros?|guamanians?", "guamanian_chamorro")]
NHPI = {
    "name": rf"{PACIFIC_GROUP}|native\s+hawaii|{HAWAIIAN}|samoans?|tongans?|fijians?|marshallese|chamorros?|guamanians?|polynesians?|micronesians?|tahitians?|maoris?",
    "native": r"natives?",
    "pacific": PACIFIC_WORD,
    "direction": r"south",
    "hawaiian_abbrev": r"nh",
    "abbrev": r"pi|opi|nhpi|nhopi",
    "filler": r"peoples?|persons?|only|of|descent|origins?|ancestry|ethnicity",
    "join": JOIN_WORDS,
}

#: The joint Asian and Pacific category of 1977.
GROUPED_PACIFIC = r"(?:other\s+)?(?:pacific(?:\s+isl(?:anders?|ands?|a)?)?|pi|islanders?|hawaiian\s+islanders?)|(?:native\s+)?hawaiians?"
GROUPED_TOGETHER = r"asian(?:\s+americans?)?\s+(?:(?:other\s+)?pacific(?:\s+islanders?)?|hawaiians?)"
GROUPED_JOINED = r"asian\s*(?:&|and)\s*(?:other\s+)?pacific\s+islanders?(?:\s*(?:heritage|heritag|herit|hertage|heri|her|hrtg|h)\.?)?"

#: Wordings of the British censuses.
UK = {
    "asian": r"asians?",
    "black": r"black",
    "white": r"white",
    "mixed": r"mixed|multiple|mulitple",
    "british": r"british",
    "nation": r"northern\s+iris(?:h)?|irish|english|welsh|scottish",
    "asian_sub": r"indian|pakistani|bangladeshi|chinese",
    "black_sub": r"afro\s+caribbean|african\s+caribbean|caribbean|carribean|africa|african",
    "other": r"any\s+other|all\s+other|other",
    "background": r"background",
    "ethnic": r"ethnic|groups?",
    "filler": r"race|origin|of",
    "or": r"or",
    "and": r"and",
}
UK_RACES = {"asian": "asian", "black": "black_african_american", "white": "white", "asian_sub": "asian", "black_sub": "black_african_american", "nation": "white"}
UK_SUBS = [
    (r"indian", "south_asian_indian"), (r"pakistani", "south_asian_pakistani"), (r"bangladeshi", "south_asian_bangladeshi"), (r"chinese", "chinese"), (r"african|africa", "african"),
    (r"caribbean|carribean|afro\s+caribbean|african\s+caribbean", "caribbean"),
]
UK_GROUPS = ["asian", "black", "white", "mixed", "british", "nation", "asian_sub", "black_sub"]

#: European names, nationalities and Roma groups.
EUROPEAN = {
    "name": r"european\s+americans?|europeans?|europe|pakehas?",
    "white": r"white|caucasians?",
    "other": r"other",
    "direction": r"north(?:ern)?|south(?:ern)?|east(?:ern)?|west(?:ern)?|central|mid|middle(?!\s*east)",
    "new_zealand": r"new\s+zealand(?:ers?)?|nz",
    "nationality": r"albanians?|andorrans?|austrians?|belarusians?|belarussians?|byelorussians?|belorussians?|belgians?|bosnians?|british|bulgarians?|croatians?|croats?|czechs?|danish|danes?|dutch|english|estonians?|finnish|finns?|flemish|french|germans?|greeks?|hungarians?|icelandic|icelanders?|irish|italians?|kosovars?|latvians?|lithuanians?|luxembourg(?:ers?|ish)|macedonians?|maltese|moldovans?|montenegrins?|norwegians?|polish|portuguese|romanians?|russians?|scandinavians?|scots?|scottish|serbians?|serbs?|slovakians?|slovaks?|slovenians?|slovenes?|swedish|swedes?|swiss|ukrainians?|welsh",
    "roma": r"romani|roma|sinti|gypsies|gipsies|gypsy|gipsy",
    "traveller": r"travell?ers?",
    "filler": r"descent|origins?|ancestry|background|peoples?|of|only|e\s*g|i\s*e",
    "join": JOIN_WORDS,
}
UK_NATIONS = ["british", "english", "welsh", "scottish", "scots", "scot", "irish"]

#: Asian names, places and directions with their subcategories.
ASIAN_NAMES = [
    (r"asian\s+indians?|east\s+indians?", "south_asian_indian"),
    (r"asian\s+americans?|american\s+asians?|asians?", None),
    (r"orientals?|oriential", None),
    (r"chinese|han", "chinese"),
    (r"japanese", "japanese"),
    (r"(?:south\s+)?koreans?", "korean"),
    (r"vietnamese", "vietnamese"),
    (r"filipin(?:o|a)s?", "filipino"),
    (r"pakistanis?", "south_asian_pakistani"),
    (r"bangladeshis?", "south_asian_bangladeshi"),
    (r"sri\s+lankans?|nepal(?:ese|is?)|desis?", "south_asian"),
    (r"thais?", "southeast_asian_thai"),
    (r"cambodians?", "southeast_asian_cambodian"),
    (r"laotians?", "southeast_asian_laotian"),
    (r"malaysians?", "southeast_asian_malaysian"),
    (r"indonesians?|javanese", "southeast_asian_indonesian"),
    (r"taiwanese", "east_asian_taiwanese"),
    (r"burmese|hmong|malays?|singaporeans?", "southeast_asian"),
]
ASIAN_PLACES = [
    (r"(?:mainland\s+)?china(?:\s+mainland)?", "chinese"),
    (r"japan", "japanese"),
    (r"(?:south\s+)?korea", "korean"),
    (r"india", "south_asian_indian"),
    (r"pakistan", "south_asian_pakistani"),
    (r"bangladesh", "south_asian_bangladeshi"),
    (r"sri\s+lanka|nepal", "south_asian"),
    (r"viet\s*nam", "vietnamese"),
    (r"phil+ip+ines", "filipino"),
    (r"thailand", "southeast_asian_thai"),
    (r"taiwan", "east_asian_taiwanese"),
    (r"malaysia", "southeast_asian_malaysian"),
    (r"indonesia", "southeast_asian_indonesian"),
    (r"cambodia", "southeast_asian_cambodian"),
    (r"laos", "southeast_asian_laotian"),
    (r"myanmar|burma|singapore", "southeast_asian"),
    (r"asia", None),
]
ASIAN_DIRECTIONS = [
    (r"north\s*east(?:ern)?", "east_asian"),
    (r"south\s*east(?:ern)?", "southeast_asian"),
    (r"east(?:ern)?", "east_asian"),
    (r"south(?:ern)?", "south_asian"),
    (r"central", None),
    (r"west(?:ern)?", None),
]
ASIAN_SUBCONTINENT, ASIAN_INDIAN = r"(?:the\s+)?(?:indian\s+)?sub\s*continent", r"indian\s+americans?|indians?"
ASIAN_SUBS = [*ASIAN_NAMES, *ASIAN_PLACES, *ASIAN_DIRECTIONS, (ASIAN_SUBCONTINENT, "south_asian"), (ASIAN_INDIAN, "south_asian_indian")]
ASIAN = {
    "west_indian": r"west\s+indians?",
    "subcontinent": ASIAN_SUBCONTINENT,
    "name": "|".join(p for p, _ in ASIAN_NAMES),
    "indian": ASIAN_INDIAN,
    "place": "|".join(p for p, _ in ASIAN_PLACES),
    "negation": r"other\s+than|except(?:\s+for)?|excluding|non|not|no",
    "other": r"any\s+other|others?",
    "direction": "|".join(p for p, _ in ASIAN_DIRECTIONS),
    "example": r"e\s*g|including|includes|etc",
    "filler": r"descent|decent|origins?|ancestry|ancestral|background|ethnicity|ethnic|ethinic|race|racial|peoples?|populations?|subjects?|participants?|nationality|only|of|from|in|i\s*e|total|number",
    "join": JOIN_WORDS,
}
ASIAN_REGIONS = {
    "chinese": "east_asian", "japanese": "east_asian", "korean": "east_asian", "east_asian_taiwanese": "east_asian", "vietnamese": "southeast_asian", "filipino": "southeast_asian",
    "south_asian_indian": "south_asian", "south_asian_pakistani": "south_asian", "south_asian_bangladeshi": "south_asian", "southeast_asian_thai": "southeast_asian",
    "southeast_asian_cambodian": "southeast_asian", "southeast_asian_laotian": "southeast_asian", "southeast_asian_malaysian": "southeast_asian", "southeast_asian_indonesian": "southeast_asian",
    "east_asian": "east_asian", "south_asian": "south_asian", "southeast_asian": "southeast_asian",
}

#: Black names with their subcategories.
BLACK_SUBS = [
    (r"african\s+americans?|afro\s+americans?|black\s+americans?|african\s+amer|afr\s+amer", "african_american"),
    (r"afro\s*car{1,2}ib{1,2}eans?|african\s+car{1,2}ib{1,2}eans?|car{1,2}ib{1,2}eans?|west\s+indians?", "caribbean"),
    (r"haitians?", "caribbean_haitian"),
    (r"jamaicans?", "caribbean_jamaican"),
    (r"sub\s*saharan\s+africans?|africans?|afro\s+descendants?|zulus?|xhosas?|yorubas?|igbos?|hausas?|fulanis?|akans?|ashantis?|luos?|kikuyus?|bantus?|kenyans?|ghanaians?|nigerians?|ethiopians?|eritreans?|somalis?|rwandans?|ugandans?|zimbabweans?", "african"),
    (r"blacks?|negro(?:es)?", None),
]
BLACK = {
    "place": r"south\s+africans?|south\s+africa|africa|kenya|uganda|rwanda|nigeria|ghana|ethiopia|somalia|zimbabwe|brazil|canadians?|canada",
    "name": "|".join(p for p, _ in BLACK_SUBS),
    "abbrev": r"aa|af\s+am",
    "direction": r"west(?:ern)?|east(?:ern)?|central|southern",
    "other": r"other",
    "example": r"e\s*g|i\s*e|including|etc",
    "filler": r"descent|decent|origins?|ancestry|background|ethnicit(?:y|ies)|ethnic|race|racial|peoples?|only|of|from|in|all|tribes?|groups?|speaking|continent|self\s+reported|participants?|subjects?",
    "qualifier": r"non\s+specified|unspecified|indigenous",
    "join": JOIN_WORDS,
}
BLACK_REGIONS = {"caribbean_haitian": "caribbean", "caribbean_jamaican": "caribbean", "caribbean": "caribbean", "african": "african", "african_american": "african_american"}
BLACK_GLOSS = r"\(\s*(?:afr|ame|amer|bla|b|af|am|aa|us)\.?(?:\s*(?:\s|/|\bor\b)\s*(?:afr|ame|amer|bla|b|af|am|aa|us)\.?)*\s*\)"
AFRICAN_SLASH_AMERICAN = r"\bafrican\s*/\s*american(?![^a-z]*indian)(?=\s*(?:$|[/,;&)]|(?:or|and)\b))"
HEADING_JOINS = ["and", "&", ",", "/"]
DIMENSION_WORDS = ["race", "racial", "ethnic", "ethnicity", "ethnicities", "ancestry", "origin", "origins", "background"]
HEADING_WORDS = [*DIMENSION_WORDS, "group", "groups", "self reported"]
ANY_RACE_WORDS = ["race", "racial", "ethnic", "ethnicity", "ethnicities", "participant", "participants", "subject", "subjects"]

#: The heritage template: its words, glosses, qualifiers, abbreviations and non-answers.
HERITAGE = r"(?<![a-z])(?:heritage|heritag|herit|hertage|heri|her|hrtg|h)\.?(?![a-z])"
HERITAGE_GLOSS = r"\(\s*[a-z]{1,4}\.?(?:\s*[/ ]\s*[a-z]{1,4}\.?)*\s*\)"
HERITAGE_COUNT = r",?\s*n\s*\(\s*%\s*\)\s*$"
HERITAGE_MULTIPLE = r"^(?:multiple|mixed)\s*[\-:–—]\s*"
HERITAGE_QUALIFIER = r"^(white|wh|wt|w|asian|black|african\s+american)\s*[\-:;–—,]\s*(?=\S)"
HERITAGE_QUALIFIERS = {"white": "white", "wh": "white", "wt": "white", "w": "white", "asian": "asian", "black": "black_african_american", "african american": "black_african_american"}
HERITAGE_PARTS = r"\s*(?:&|\band\b)\s*"
HERITAGE_GROUPS = r"\s*(?:/|&|\bor\b|\band\b)\s*|\s+[\-–—]\s*|\s*[\-–—]\s+"
HERITAGE_DIRECTIONS = ["east", "south", "central", "west", "north", "south east", "southeast", "south-east"]
HERITAGE_SHORT = {
    "w": "white", "wh": "white", "wt": "white", "eu": "white", "eur": "white", "cau": "white", "aa": "black_african_american", "afr amer": "black_african_american", "af am": "black_african_american",
    "afam": "black_african_american", "african amer": "black_african_american", "african amc": "black_african_american", "american indian": "american_indian_alaska_native",
    "amer ind": "american_indian_alaska_native", "am ind": "american_indian_alaska_native", "al n": "american_indian_alaska_native", "alaska n": "american_indian_alaska_native",
    "alaskan n": "american_indian_alaska_native", "alaska native": "american_indian_alaska_native", "alaskan native": "american_indian_alaska_native", "ala native": "american_indian_alaska_native",
    "ai": "american_indian_alaska_native", "an": "american_indian_alaska_native", "af": "black_african_american", "afr": "black_african_american", "nat hawaiian": "native_hawaiian_pacific_islander",
    "other pacific islander": "native_hawaiian_pacific_islander", "other pacific islanders": "native_hawaiian_pacific_islander", "asi": "asian", "east a": "asian", "east asi": "asian", "south a": "asian",
    "south east a": "asian", "southeast a": "asian", "sea": "asian",
}
NO_ANSWER = r"(?<![a-z])(?:refus\w*|declin\w*|prefer\w*|unknown|unspecified|unavailable|withheld|missing|none|not)(?![a-z])"
SHORT_NO_ANSWERS = ["na", "nr", "nk", "dk", "unk"]
NEGATION = r"(?<![a-z])(?:non|not|no)(?![a-z])|(?<![a-z])non(?=[a-z])"

#: Labels of several races: what announces them, what joins them, and category names that hold "and".
SEVERAL = r"^(?:multiple(?:\s+races?)?|multi[\s-]?racial|mixed(?:\s+races?)?|bi[\s-]?racial|more\s+than\s+one\s+races?|two\s+or\s+more\s+races)\s*(?:[\-:–—(]\s*|\s+(?=\S))"
SEVERAL_PARTS = r"\s*(?:,|;|&|\+|\band\b)\s*"
SEVERAL_JOIN = r"&|\+|\band\b"
ONE_CATEGORY = [(r"native\s+hawaiians?\s+and\s+(?:other\s+)?pacific\s+islanders?", "Native Hawaiian or Other Pacific Islander"), (r"american\s+indians?\s+and\s+alaskan?\s+natives?", "American Indian or Alaska Native")]
