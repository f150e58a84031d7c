"""Engine parameters.

Fixed values (must stay equal to the indexing settings and search parameters
being re-implemented; stated here together, in natural order):

* access tiers, in clearance order: general, level_q, admin
* clearance lists: general -> [general]; level_q -> [general, level_q];
  admin -> [general, level_q, admin]
* token text units: 300 tokens, 100 overlap (stride 200)
* word chunks for the vector path: 512 words, 50 overlap (stride 462),
  chunked only when a document has more than 512 words
* truncation before embedding: 512 tokens
* maximum community size: 10
* description summary cap: 500 tokens
* community report context: 8000 tokens
* search context: 12000 tokens; answer budget 2000 tokens
* local search: text units 50 %, community reports 10 % of the budget,
  top 10 entities, top 10 relationships, 5 history turns (user turns only)
* embedding batches: 16 inputs or 8191 tokens
* query community level: 2; minimum community rank 0
* vector search: top 5, score = cosine similarity + 1.0
* extraction record format: tuple delimiter "<|>", record delimiter "##",
  completion marker "<|COMPLETE|>"
* claim status values: TRUE, FALSE, SUSPECTED; missing value marker NONE
"""

TIERS = ("general", "level_q", "admin")
CLEARANCE = {
    "general": ("general",),
    "level_q": ("general", "level_q"),
    "admin": ("general", "level_q", "admin"),
}

UNIT_SIZE, UNIT_OVERLAP = 300, 100
UNIT_STRIDE = UNIT_SIZE - UNIT_OVERLAP
WORD_CHUNK, WORD_OVERLAP = 512, 50
WORD_STRIDE = WORD_CHUNK - WORD_OVERLAP
EMBED_TRUNCATE = 512

MAX_CLUSTER_SIZE = 10
SUMMARY_CAP = 500
REPORT_BUDGET = 8000
SEARCH_BUDGET = 12000
ANSWER_BUDGET = 2000
TEXT_UNIT_PROP, COMMUNITY_PROP = 0.5, 0.1
TOP_K_ENTITIES, TOP_K_RELATIONSHIPS = 10, 10
HISTORY_TURNS = 5
EMBED_BATCH_SIZE, EMBED_BATCH_TOKENS = 16, 8191
QUERY_COMMUNITY_LEVEL = 2
MIN_COMMUNITY_RANK = 0
VECTOR_TOP_K = 5

TUPLE_DELIM, RECORD_DELIM, COMPLETE = "<|>", "##", "<|COMPLETE|>"
CLAIM_STATUS = ("TRUE", "FALSE", "SUSPECTED")

# --- rule-based extraction (the engine's deterministic stand-in for the
# model call; own design, not reference values) ---
ENTITY_WORD_RE = r"^\p{Lu}\p{L}+$"        # capitalised word of any script with case
LETTER_RUN_RE = r"\p{L}+"
SENTENCE_RE = "[^.!?\n]+[.!?]?"
WS_TOKEN_RE = "[^ \t\n\r\f]+"
# type rule by upper-cased suffix, first match wins
TYPE_RULES = (("%TION", "EVENT"), ("%ER", "PERSON"), ("%OR", "PERSON"), ("%AN", "GEO"), ("%IA", "GEO"))
DEFAULT_TYPE = "ORGANIZATION"
# entity types each tier extracts (general tier does not extract persons)
TIER_TYPES = {
    "general": ("ORGANIZATION", "GEO", "EVENT"),
    "level_q": ("ORGANIZATION", "GEO", "EVENT", "PERSON"),
    "admin": ("ORGANIZATION", "GEO", "EVENT", "PERSON"),
}

# salt buckets for joins on keys that can be hubs
SKEW_SALT_BUCKETS = 8
SHUFFLE_SEED = "strata"
