"""Fixed values.

Every value in this module must stay exactly as written for results to match
the behaviour the engine reproduces: word lists, phrase lists, selector lists,
the search catalogue, the output model and the two prompt texts. They are kept
together, in their natural order, and are only read by the operators.
"""

# --------------------------------------------------------------------------
# FIXED VALUES — do not edit
# --------------------------------------------------------------------------

# UI lines skipped right after the answer anchor (compared lower-cased and stripped).
SKIP_EXACT = [
    "thinking",
    "searching",
    "draft",
    "meet ai mode",
    "filters and topics",
    "ai mode",
    "all",
    "images",
    "videos",
    "news",
    "more",
    "shopping",
    "maps",
    "books",
    "flights",
    "finance",
    "start new search",
    "help me pack for my trip to kerala next week",
    "compare leather sofas vs fabric sofas",
    "how to identify if the pashmina shawl i am buying is genuine?",
]

# The answer ends at the first line containing any of these (lower-case substring).
FOOTER_MARKERS = [
    "ai can make mistakes",
    "ai overview can make mistakes",
    "ai overviews can make mistakes",
    "your feedback helps google improve",
    "thank you for your feedback",
    "thank you",
    "share more feedback",
    "report a problem",
    "report legal issue",
    "10 sites",
    "search results",
    "dismiss",
    "my ad centre",
    "turn on your visual search history",
    "learn more about these results",
    "about this result",
    "view all",
    "see more",
]

# What an envelope without an answer says.
FAILURE_TEXT = "No usable AI response found."
# And what it says where the question could not be asked.
NO_INPUT_TEXT = "Could not find AI Mode input box."

# An answer whose first 300 normalised characters hold one of these is not usable.
UI_PHRASES = [
    "quick settings sign in",
    "ai mode all images videos news more shopping maps",
    "google apps sign in",
    "you said:",
    "more input options microphone",
    "stop send send ask about",
    "loading",
]

# Minimum normalised answer length and the length of the UI-phrase window.
MEANINGFUL_MIN_CHARS = 80
UI_PHRASE_WINDOW = 300

# Answer deadline after the question is asked, seconds.
ANSWER_DEADLINE_S = 70

# Region size floors: matched element / body fallback (stripped innerHTML length, exclusive).
REGION_MIN_CHARS = 50
BODY_MIN_CHARS = 100

# Sources dropped from the completion's "sources" list (exact, after strip + lower).
INVALID_SOURCES = [
    "overview",
    "justdial",
    "justdial.com",
    "weddingwire",
    "weddingwire.in",
    "weddingwire.com",
]

# Response-region selectors in rank order: (kind, attribute, value, scope).
#   kind "class"  : div whose class attribute contains value
#   kind "attr"   : div whose attribute equals value
#   kind "id"     : div with that id
#   scope         : id of a div that must enclose the match (or None)
RESPONSE_SELECTORS = [
    ("class", "class", "ai-mode-response", None),
    ("attr", "data-attrid", "AIResponse", None),
    ("class", "class", "generated-content", None),
    ("attr", "data-attrid", "SGEAnswer", None),
    ("class", "class", "VjFXz", None),
    ("class", "class", "ai-overview", None),
    ("class", "class", "SPZz6b", None),
    ("class", "class", "g", "rso"),
    ("class", "class", "kp-blk", None),
    ("id", "id", "search", None),
    ("id", "id", "main", None),
]

# Removed subtrees before text extraction.
NOISE_TAGS = ["script", "style", "noscript", "svg"]

# Trailing "<source> +N" junk removed from table cells.
CELL_SOURCE_JUNK = ["IBM", "Quora", "TechTarget"]

# Brand names removed from answers (whole words, any case).
ANSWER_BRAND_PATTERN = r"(?:justdial(?:\.com)?|weddingwire(?:\.in|\.com)?)"

# Block-page markers.
BLOCK_FORM_ID = "captcha-form"
BLOCK_TEXT = "detected unusual traffic"

# Overview extraction: anchor text, container fallback classes, dropped classes, stop phrases.
OVERVIEW_ANCHOR_TEXT = "AI Overview"
OVERVIEW_ANCHOR_TAGS = ["h1", "h2", "h3", "div"]
OVERVIEW_CLIMB_STEPS = 5
OVERVIEW_FALLBACK_CLASS = "Kevs9"
OVERVIEW_FALLBACK_CLASS_PATTERN = "AI_Overview|AIO"
OVERVIEW_DROP_CLASS_PATTERN = "wJwe6c|WTfRgd|citation|source"
OVERVIEW_LEAF_TAGS = ["p", "li", "div", "span"]
OVERVIEW_STOP_PHRASES = ["show more", "show less", "feedback", "ai overview"]

# Search catalogue: category -> ordered search groups (name, description, fields).
SEARCH_MODELS = {
    "WEDDING_PLANNERS": [
        ("contact", "Official contact information",
         ["website", "instagram", "facebook", "google_business", "phone", "email", "address"]),
        ("reviews", "Ratings and reputation",
         ["rating", "review_count", "trust_rating"]),
        ("pricing", "Pricing and packages",
         ["price_range"]),
        ("services", "Wedding planning services",
         ["planning_speciality", "wedding_types_covered", "services_offered",
          "destination_wedding_support", "decoration_styles", "cities_covered",
          "guest_hospitality_management", "entertainment_services"]),
    ],
}

# Output model per category: ordered (field, kind) with kind "string" or "array".
OUTPUT_MODELS = {
    "WEDDING_PLANNERS": [
        ("website", "string"),
        ("instagram", "string"),
        ("facebook", "string"),
        ("google_business", "string"),
        ("phone", "string"),
        ("email", "string"),
        ("price_range", "string"),
        ("rating", "string"),
        ("review_count", "string"),
        ("planning_speciality", "array"),
        ("wedding_types_covered", "array"),
        ("services_offered", "array"),
        ("destination_wedding_support", "string"),
        ("decoration_styles", "array"),
        ("cities_covered", "array"),
        ("guest_hospitality_management", "array"),
        ("entertainment_services", "array"),
        ("sources", "array"),
        ("address", "string"),
    ],
}

# Search sources per group name, highest priority first; any other group uses "*".
SOURCE_PRIORITIES = {
    "contact": ["Official Website", "Google Business Profile", "Instagram", "Facebook",
                "Business Directories"],
    "pricing": ["Official Website", "Pricing Pages", "Instagram Posts", "Facebook Posts",
                "Wedding Blogs", "any other listing website"],
    "reviews": ["Google Business Profile", "Official Website", "Facebook", "News Articles"],
    "*": ["Official Website", "Portfolio Pages", "Instagram", "Facebook", "Event Galleries",
          "Customer Reviews", "Blogs"],
}

# Country written after the city in every research question.
QUESTION_COUNTRY = "India"

# Research question text; {sources} is the numbered source list, one per line.
# The finished question is collapsed to one line (runs of whitespace -> one space).
QUESTION_TEMPLATE = """
You are researching a business.

Business Name:
{vendor_name}

Category:
{category}

Location:
{city}, {country}

Search Objective:
{description}

Search every parameter independently.

Parameters:

{parameters}

Search Sources (highest priority first):

{sources}

Rules:

1. Search EVERY parameter individually.
2. Do not stop after finding some information.
3. Never guess.
4. Never estimate.
5. Never infer missing information.
6. Only use information that can be verified.
7. If multiple values exist, choose the highest priority source.
8. If conflicting values exist, report the highest priority source.
9. If information cannot be verified after checking all sources,
   return exactly:

Not Found

Return the result exactly in this format:

Parameter:
Value:
Source URL:

Repeat for every parameter.
"""

# Default platform name written into the extraction prompt.
PROMPT_PLATFORM = "the vendor directory"

# Short search query (unused by the main flow, kept as an operator).
SHORT_QUERY_SUFFIX = "wedding planner"

# Sentinel for an unverifiable value.
NOT_FOUND = "Not Found"

# Extraction prompt; slots are $vendor_name $city $state $content $output_format,
# filled in a single pass. <<platform>> is the publishing platform's name, set
# once per run (PROMPT_PLATFORM by default) before the slots are filled.
PROMPT_TEMPLATE = """
/no_think
You are a Vendor Enrichment AI Agent for <<platform>>.

Your job is to extract structured information about Wedding Planner vendors from unstructured or semi-structured content including websites, Google Business Profiles, Instagram pages, Facebook pages, directories, and notes.

You are NOT a content writer.

You are NOT allowed to generate, infer, estimate, assume, or hallucinate information.

---

## Primary Objective

Extract ONLY information that is explicitly present in the provided content.

If a field is not explicitly present, return "" (empty string).

---

## CRITICAL EXTRACTION RULES (VERY IMPORTANT)

1. Do NOT guess or infer missing data.
2. Do NOT estimate or approximate values.
3. Do NOT derive from vendor name, city, or category.
4. Do NOT create new values.
5. If unsure, return "".
6. If multiple conflicting values exist, return "".
7. Return valid JSON only.
8. No explanation, no markdown, no notes.

---

## 🔥 STRICT EXTRACTION OVERRIDE RULE (IMPORTANT FIX)

Treat the following patterns as VALID explicit data sources:

- "Website: <url>"
- "Website Value: <url>"
- "Official Website: <url>"
- "Source URL: <url>"
- Any standalone URL (http/https)
- Any URL inside descriptive text or research blocks

👉 If a URL is present anywhere in the input, it MUST be extracted into the correct field unless explicitly marked as "Not Found".

---

## FIELD MAPPING RULES

Extract only if explicitly present:

- website → any official website URL
- instagram → instagram link
- facebook → facebook link
- email → email address
- phone → phone number
- address → full address string
- price_range → pricing explicitly stated
- rating → rating only if numeric value is present
- review_count → only if explicitly stated

---

## Vendor Information

Vendor Name:
$vendor_name

City:
$city

State:
$state

---

## Content To Analyze

$content

---

## Output Format

$output_format

Return ONLY valid JSON.
No markdown.
No commentary.
"""

# Section header rule around each group's answer block: 16 "=" each side.
SECTION_RULE = "=" * 16
# Indentation that survives in front of each block's text.
SECTION_TEXT_INDENT = " " * 4
