"""Fixed values that must equal the analysed corpus workflow's own settings.

Everything in this module is data, not logic: phrase dictionaries, word lists,
regular expressions and the curated topic-label table.  They are kept in their
natural order, as plain text, so a reader can check them against the source.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the reference settings for identical results.
# ---------------------------------------------------------------------------

# Corpus filter bounds (raw text length, inclusive) and the language kept.
MIN_TEXT_LEN = 500
MAX_TEXT_LEN = 50_000
LANGUAGE = "en"

# Prefix lengths used by the stages.
EMBED_MAX_CHARS = 1000          # title + first 1000 chars go to the encoder
ENTITY_MAX_CHARS = 2000         # entity model sees 2000 chars of "title. text"
SENTIMENT_MAX_CHARS = 2000      # sentiment model sees 2000 chars of the text
TOPIC_MAX_WORDS = 300           # topic text = title + ". " + first 300 words
KEEP_TOP_SHARE = 0.70           # relevance filter keeps the top 70 %

# Light clean patterns (Python `re` syntax as published).
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_PATTERN = r"(\+?\d{1,2}[\s.-]?)?(\(?\d{3}\)?[\s.-]?)\d{3}[\s.-]?\d{4}"
BOILERPLATE_SNIPPETS = [
    r"subscribe\s+to\s+our\s+newsletter",
    r"sign\s+up\s+for\s+our\s+newsletter",
    r"privacy\s+policy",
    r"terms\s+of\s+service",
    r"cookie(s)?\s+policy",
    r"all\s+rights\s+reserved",
    r"advertisement",
    r"read\s+more",
]

# Company-name normalisation: words dropped after lower-casing.
CORP_SUFFIXES = [
    "inc", "inc.", "corp", "corp.", "corporation", "ltd", "ltd.", "llc", "plc",
    "group", "holdings", "holding", "co", "co.", "company",
]
# Companies matching this (case-blind) are dropped from company counts.
COMPANY_EXCLUDE_PATTERN = "Ai$"
# Characters stripped from both ends of an entity span.
SPAN_STRIP_CHARS = " .,;:|()[]{}\"'"

# Impact-mode dictionary: label -> phrases (substring test on lower-cased text).
IMPACT_KEYWORDS = {
    "automation": [
        "automate", "automated", "automation", "fully automated", "autonomously",
        "autonomous processing", "machine-led", "replace manual work", "replace human work",
        "replace workers", "replace staff", "reduce headcount", "eliminate routine tasks",
        "task automation", "document automation", "underwriting automation",
        "decision automation", "robotic process automation", "rpa", "self-service",
        "without human intervention",
    ],
    "augmentation": [
        "augment", "augmentation", "assist", "assistance", "support workers",
        "support employees", "decision support", "copilot", "co-pilot", "assistant",
        "ai assistant", "human in the loop", "human-in-the-loop", "collaborate with",
        "enhance human", "improve clinician performance", "recommendation engine",
        "advisory tool", "decision aid", "support clinicians", "support teachers",
        "support developers",
    ],
    "workflow_redesign": [
        "workflow redesign", "workflow transformation", "workflow optimization",
        "workflow automation", "business process redesign", "business process transformation",
        "process redesign", "process transformation", "process optimization",
        "operational redesign", "operational transformation", "streamline operations",
        "streamline workflow", "integrated workflow", "embedded into workflow",
        "digital transformation", "reengineer processes", "re-engineer processes",
        "change how work is done", "reshape operations",
    ],
    "cost_reduction": [
        "reduce cost", "reduce costs", "cut cost", "cut costs", "lower cost", "lower costs",
        "cost reduction", "cost savings", "save money", "saving money", "reduce spending",
        "lower spending", "operational savings", "efficiency savings", "labor savings",
        "lower labor costs", "decrease expenses", "reduced overhead", "improve margins",
        "margin improvement",
    ],
    "productivity_gain": [
        "productivity", "increase productivity", "boost productivity", "improve efficiency",
        "increase efficiency", "greater efficiency", "faster", "faster turnaround",
        "speed up", "speeds up", "accelerate", "accelerates", "shorten turnaround",
        "reduce turnaround time", "save time", "time savings", "handle more work",
        "scale output", "higher throughput", "fewer bottlenecks", "improve performance",
    ],
    "risk_or_disruption": [
        "job loss", "job losses", "layoffs", "workforce reduction", "displace workers",
        "worker displacement", "disruption", "operational risk", "compliance risk", "bias",
        "hallucination", "safety concern", "security risk", "cyber risk", "ethical concern",
        "governance risk", "regulatory risk", "uncertainty", "hard to say", "unclear impact",
        "mixed impact", "unintended consequences", "threat to jobs", "replace jobs",
    ],
}

# Technology dictionary: label -> phrases.
TECHNOLOGY_KEYWORDS = {
    "llm": ["large language model", "large language models", "llm", "llms", "foundation model", "foundation models", "generative ai", "genai", "language model"],
    "computer_vision": ["computer vision", "image recognition", "image analysis", "vision model", "medical imaging", "object detection", "visual inspection"],
    "predictive_analytics": ["predictive analytics", "prediction model", "forecasting", "risk scoring", "risk model", "scoring model"],
    "decision_support_system": ["decision support", "recommendation engine", "clinical decision support", "advisory system", "decision engine"],
    "automation_platform": ["robotic process automation", "rpa", "workflow automation", "process automation", "orchestration"],
    "chatbot_or_assistant": ["chatbot", "virtual assistant", "ai assistant", "copilot", "co-pilot"],
}

# Base English stop words (the published list of Spark ML's StopWordsRemover).
BASE_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these",
    "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll",
    "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's",
    "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought",
    "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]

# Domain stop words added to the base English list for topic keywords.
DOMAIN_STOPWORDS = [
    "ai", "artificial", "intelligence", "machine", "learning", "model", "models",
    "data", "system", "systems", "technology", "technologies", "tool", "tools",
    "platform", "platforms", "software", "solution", "solutions", "generative",
    "research", "company", "companies", "business", "industry", "industries",
    "digital", "development", "management", "future", "global", "world",
    "market", "markets", "share", "stock", "stocks", "public", "high",
    "news", "content", "home", "search", "menu", "subscribe", "watch",
    "videos", "video", "press", "updated", "latest", "live", "contact",
    "support", "help", "events", "insights", "local", "sign", "skip",
    "features", "releases", "view", "best", "year", "month", "day", "time",
    "india", "china", "country", "united", "states", "like", "people", "work",
    "ceo", "human", "users", "team", "free", "real", "based", "use", "today",
    "prnewswire", "google", "nasdaq", "sports", "music", "entertainment",
    "politics", "tv", "media", "published", "including", "just", "make",
    "made", "announced", "announce", "power", "email", "leading", "used",
    "using", "key", "create", "creates", "created", "years", "said", "says",
    "according", "report", "reported", "reports", "statement", "release",
    "via", "across", "major", "next", "first", "top", "big", "growing",
    "grows", "growth", "million", "billion", "percent", "per", "cent",
    "service", "services", "product", "products", "experience", "customer",
    "customers", "capabilities", "access", "helps", "enable", "enables",
    "allow", "allows", "thing", "things", "way", "ways", "part", "well",
    "much", "many", "also", "still", "even", "am", "pm", "ago", "days",
    "need", "making", "open", "openai", "chatgpt", "one", "two", "three",
    "four", "five", "six", "seven", "eight", "nine", "ten", "hours", "state",
    "monday", "tuesday", "wednesday", "thursday", "friday", "january",
    "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december", "microsoft", "apple",
    "facebook", "meta", "twitter", "nvidia", "applications", "application",
    "language", "large", "supports", "type", "types", "com", "www", "http",
    "https", "10", "00",
]

# Topic vectoriser settings.
NGRAM_RANGE = (1, 2)
MIN_DF = 10
MAX_DF = 0.6
TOP_N_WORDS = 10

# Density clustering settings (min cluster size, min samples) and reduced dims.
MIN_CLUSTER_SIZE = 200
MIN_SAMPLES = 20
REDUCED_DIMS = 5

# Curated topic labels: (topic, topic_name, industry_label, keep).
TOPIC_LABELS = [
    (-1, "Outliers / noise", "Noise", 0),
    (0, "AI chips and GPUs", "AI Infrastructure", 1),
    (1, "AI in healthcare and medical imaging", "Healthcare", 1),
    (2, "Newswire template / geography noise", "Noise", 0),
    (3, "Enterprise AI adoption (IT services)", "Enterprise IT", 1),
    (4, "AI cybersecurity", "Cybersecurity", 1),
    (5, "AI in lending and financial services", "Finance", 1),
    (6, "China AI ecosystem", "Global AI Competition", 0),
    (7, "AI safety and existential risk", "AI Governance / Risk", 1),
    (8, "Autonomous vehicles and mobility AI", "Transportation", 1),
    (9, "Consumer AI assistants and devices", "Consumer Electronics", 1),
    (10, "AI in education", "Education", 1),
    (11, "AI and crypto / Web3", "Crypto / Web3", 1),
    (12, "Website navigation / template noise", "Noise", 0),
    (13, "AI regulation and national policy", "Government / Regulation", 1),
    (14, "AI adoption in small businesses", "Small Business", 1),
    (15, "National AI strategy and global hubs", "Government / Regulation", 1),
    (16, "Generative AI for media and video", "Media / Content Creation", 1),
    (17, "AI company governance events", "AI Governance / Risk", 1),
    (18, "AI model competition and launches", "Noise", 0),
]

# Sentiment label ids.
ID2LABEL = {0: "negative", 1: "neutral", 2: "positive"}

# Dashboard formats: month label, excerpt length, keywords shown per topic.
MONTH_LABEL_FORMAT = "yyyy-MM"
EXCERPT_CHARS = 160
EXCERPT_SUFFIX = "..."
SUMMARY_DOC_CHARS = 500
DASHBOARD_KEYWORDS = 4
DASHBOARD_TOP = 10

# Fixed value: relevance query text of the analysed workflow.
RELEVANCE_QUERY = (
    "Articles discussing how artificial intelligence impacts industries, companies, "
    "workforce, productivity, adoption, automation, regulation, business "
    "transformation, and enterprise deployment."
)
