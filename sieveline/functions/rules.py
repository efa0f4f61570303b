"""Rule sets of the curation pipeline. Every operator takes them as parameters; these are the defaults."""

# Literal replacements of damaged punctuation.
LITERALS = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", " ": " ", "﻿": "", "\x00": ""}

# Markdown rules in order (pattern, replacement).
MARKDOWN = [
    (r"!\[([^\]]*)\]\([^)]+\)", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"(\*{1,3}|_{1,3})(.+?)\1", "$2"),
    (r"~~(.+?)~~", "$1"),
    (r"(?m)^#{1,6}\s+", ""),
    (r"(?m)^[>\s]*>\s?", ""),
    (r"(?m)^[-*+]\s+", ""),
    (r"(?m)^\d+\.\s+", ""),
    (r"`{1,3}([^`]*)`{1,3}", "$1"),
    (r"(?m)^[-*_]{3,}$", ""),
]

# Boilerplate of any platform.
BOILERPLATE = [
    r"(?i)share\s+(this|on)\s+(twitter|facebook|linkedin|reddit|x\.com)",
    r"(?i)(follow\s+(us|me)\s+on)\s+(twitter|linkedin|medium|github)",
    r"(?i)(sign\s*up|log\s*in|subscribe)\s+(to|for)\s+",
    r"(?i)cookie\s+(policy|consent|preferences)",
    r"(?i)©\s*\d{4}.*?all\s+rights\s+reserved",
    r"(?i)(read\s+more|continue\s+reading)\s*(\.{3}|…)?",
    r"(?im)^\s*(advertisement|sponsored|promoted)\s*$",
    r"(?i)(subscribe\s+to|join)\s+(our|my)\s+(newsletter|mailing\s+list)",
]

# Boilerplate by platform.
PLATFORM_BOILERPLATE = {
    "gfg": [
        r"(?i)Last\s+Updated\s*:\s*\n?\s*\d{1,2}\s+\w+,?\s*\d{4}",
        r"(?s)\n\s*Comment\s*\n.*",
        r"(?s)\n\s*Article\s+Tags\s*:\s*\n.*",
        r"(?si)\n\s*Improve\s*\n\s*Suggest\s+Changes.*",
        r"(?si)\n\s*Similar\s+Reads\s*\n.*",
        r"(?i)\n\s*(Easy|Medium|Hard|Basic)\s*$",
        r"(?si)\n\s*Related\s+Articles\s*\n.*",
        r"(?i)^\s*Home\s*>.*?\n",
    ],
    "medium": [
        r"(?i)\d+\s+min(ute)?s?\s+read",
        r"(?i)Published\s+in\s+[\w\s]+",
        r"(?im)^\s*(Follow|Written\s+by|More\s+from)\s+",
        r"(?i)\d+\s*(claps?|responses?)",
        r"(?i)(Sign\s+up|Sign\s+in)\s+(with|to)\s+",
        r"(?i)Member-only\s+story",
        r"(?i)Open\s+in\s+app",
        r"(?si)\n\s*(Recommended|More)\s+from\s+Medium\s*\n.*",
        r"(?si)\n\s*About\s+(the\s+Author|Me)\s*\n.*",
        r"(?si)\n\s*Connect\s+with\s+me\s+on\s+.*",
        r"(?si)\n\s*If\s+you\s+(enjoyed|found|liked)\s+(this|my)\s+.*",
    ],
    "leetcode": [
        r"(?im)^\s*(Easy|Medium|Hard)\s*$",
        r"(?i)\d+[\d,.]*[KMB]?\s*(Accepted|Submissions|Acceptance\s+Rate)",
        r"(?i)\d+[\d,.]*[KMB]?\s*(votes?|views?|replies|likes?)",
        r"(?im)^\s*(Report|Share|Reply|Copy)\s*$",
        r"(?im)^\s*(Reputation|Badge)\s*:.*$",
        r"(?im)^\s*(Companies|Related\s+Topics?)\s*:.*$",
        r"(?im)^\s*Show\s+(Hint|Solution|Tags|Companies)\s*$",
    ],
    "reddit": [
        r"(?i)\d+\s*(upvotes?|downvotes?|comments?|points?)",
        r"(?i)Posted\s+by\s+u/\S+",
        r"(?m)^\s*r/\w+\s*$",
    ],
}

# Spellings of the platforms.
PLATFORMS = {"geeksforgeeks": "gfg", "geeks for geeks": "gfg", "geeks": "gfg", "gfg": "gfg", "medium": "medium", "medium.com": "medium", "leetcode": "leetcode", "lc": "leetcode", "leet code": "leetcode"}
VALID_PLATFORMS = ["leetcode", "gfg", "medium"]

# Personal data rules in order (type, placeholder, pattern).
PII = [
    ("email", "[EMAIL]", r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"),
    ("phone", "[PHONE]", r"(?:\+?91[\s\-]?)?(?:0?\d{2,4}[\s\-]?)?\d{5}[\s\-]?\d{5}"),
    ("phone", "[PHONE]", r"(?:\+?1[\s\-]?)?\(?\d{3}\)?[\s.\-]?\d{3}[\s.\-]?\d{4}"),
    ("phone", "[PHONE]", r"\+\d{1,3}[\s\-]?\d[\s\-\d]{6,14}"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?linkedin\.com/in/[\w\-.]+"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?github\.com/[\w\-]+(?:/[\w\-.]+)?(?=\s|$|[),;])"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?(?:twitter|x)\.com/[\w\-]+"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?instagram\.com/[A-Za-z0-9_.]+/?"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?facebook\.com/[A-Za-z0-9.]+/?"),
    ("personal_url", "[PERSONAL_URL]", r"(?i)(?:https?://)?(?:www\.)?leetcode\.com/u/[A-Za-z0-9_\-]+/?"),
    ("id_number", "[ID_NUMBER]", r"\b\d{4}[\s\-]?\d{4}[\s\-]?\d{4}\b"),
    ("id_number", "[ID_NUMBER]", r"\b\d{3}[\-]\d{2}[\-]\d{4}\b"),
    ("id_number", "[ID_NUMBER]", r"\b[A-Z]{5}\d{4}[A-Z]\b"),
    ("username", "[USERNAME]", r"\bu/[\w\-]{3,20}\b"),
    ("username", "[USERNAME]", r"(?<![\w@])@(?!Override|param|return|throws|Autowired|Component|Service|Repository|Entity|Table)[a-zA-Z][\w]{2,20}\b"),
    ("address", "[ADDRESS]", r"(?i)(?:PIN|pin|Pincode|postal)[\s:]*\d{6}"),
    ("address", "[ADDRESS]", r"(?i)(?:ZIP|zip)[\s:]*\d{5}(?:\-\d{4})?"),
]

# Error pages, searched in the first 500 characters.
ERROR_PAGES = [
    r"404\s*(not\s+found|error|page)", r"403\s*(forbidden|access\s+denied)", r"access\s+denied", r"page\s+(not\s+found|has\s+been\s+removed|no\s+longer\s+exists)",
    r"this\s+(content|article|page)\s+(is|has\s+been)\s+(unavailable|removed|deleted)", r"you\s+(need|must)\s+to\s+(log\s*in|sign\s*in|be\s+logged\s+in)",
    r"please\s+(log\s*in|sign\s*in)\s+to\s+(view|access|continue)", r"subscribe\s+to\s+(read|access|view)\s+this", r"this\s+post\s+(was|has\s+been)\s+deleted",
    r"\[removed\]", r"\[deleted\]", r"502\s+bad\s+gateway", r"503\s+service\s+unavailable", r"something\s+went\s+wrong", r"we\s+couldn'?t\s+find\s+(this|that|the)\s+page",
]

# Words that signal an interview story.
SIGNALS = (
    "interview interviewer interviewed round rounds technical screening phone onsite on-site virtual online offline campus on-campus off-campus walk-in aptitude assessment oa "
    "hiring shortlisted selected rejected ghosted offer placed asked question questions answer answered explained solved approach solution discuss discussed coding dsa algorithm "
    "data structure array string tree graph dynamic programming recursion sorting searching sql dbms oops oop os networking system design api rest behavioral hr managerial resume "
    "introduction introduce strengths weaknesses project projects experience experiences role position salary compensation ctc stipend result results cleared passed failed accepted "
    "offered joined onboarding easy medium hard difficult prepare preparation practice leetcode geeksforgeeks hackerrank codeforces"
).split()
MIN_WORDS, MAX_WORDS, MIN_SIGNAL = 50, 15000, 0.02

# Experience levels and their keywords, in order.
LEVELS = {
    "intern": ["intern", "internship", "summer intern", "winter intern", "co-op", "trainee", "apprentice"],
    "entry": ["entry level", "entry-level", "fresher", "freshman", "new grad", "new graduate", "campus hire", "junior", "associate", "level 1", "l1", "sde 1", "sde1", "swe 1", "0 years", "0-1 years", "1 year experience"],
    "mid": ["mid level", "mid-level", "level 2", "l2", "sde 2", "sde2", "swe 2", "2-4 years", "3 years experience", "4 years experience", "5 years experience"],
    "senior": ["senior", "sr.", "level 3", "l3", "sde 3", "sde3", "swe 3", "lead", "5-8 years", "6 years experience", "7 years experience", "8 years experience"],
    "staff": ["staff", "principal", "level 4", "l4", "l5", "distinguished", "8-12 years", "10 years experience"],
    "leadership": ["director", "vp", "vice president", "cto", "head of engineering", "engineering director", "l6", "l7", "c-level"],
}
# Interview types and their keywords.
INTERVIEW_TYPES = {
    "phone_screen": ["phone screen", "phone screening", "phone interview", "phone round", "telephonic", "telephonic round", "phone call"],
    "onsite": ["onsite", "on-site", "on site", "in-person", "in person", "face to face", "face-to-face", "f2f", "office visit"],
    "online_assessment": ["online assessment", "oa", "online test", "coding test", "coding round", "hackerrank test", "hackerearth test", "aptitude test", "aptitude round", "mcq test", "mcq round"],
    "virtual": ["virtual", "video call", "video interview", "zoom", "teams", "google meet", "webex", "remote interview"],
    "on_campus": ["on campus", "on-campus", "campus drive", "campus placement", "campus recruitment", "college placement", "visited our college", "visited our campus"],
    "off_campus": ["off campus", "off-campus", "referral", "applied online", "job portal", "naukri", "linkedin apply"],
    "walk_in": ["walk-in", "walk in", "walkin"],
}
# Outcomes, then difficulties, in order.
OUTCOMES = {
    "offer": ["got the offer", "received the offer", "received an offer", "got an offer", "got selected", "was selected", "i was selected", "finally selected", "officially selected", "i got in", "cleared all", "cleared the interview", "offer letter", "offer in hand", "accepted the offer", "joined", "i joined", "placed", "i was placed", "got placed"],
    "reject": ["got rejected", "was rejected", "i was rejected", "didn't get selected", "did not get selected", "not selected", "wasn't selected", "couldn't clear", "could not clear", "didn't clear", "did not clear", "failed", "rejected", "rejection", "didn't make it", "did not make it", "no offer", "not shortlisted"],
    "pending": ["waiting for result", "waiting for the result", "awaiting result", "result pending", "still waiting", "yet to hear", "haven't heard", "no response yet", "fingers crossed"],
}
DIFFICULTIES = {
    "hard": ["very difficult", "very tough", "extremely hard", "extremely difficult", "very challenging", "really tough", "really hard", "quite difficult", "struggled", "struggled a lot", "couldn't solve", "could not solve", "very tricky"],
    "medium": ["moderate", "moderately difficult", "not too hard", "not too easy", "decent difficulty", "average difficulty", "manageable", "somewhat challenging", "a bit tricky"],
    "easy": ["very easy", "quite easy", "really easy", "straightforward", "simple questions", "basic questions", "easy questions", "not difficult", "no difficulty", "smooth", "went smoothly", "comfortable"],
}
# Phrases that count interview rounds.
ROUND_COUNTS = [
    r"round\s*(\d+)", r"(\d+)(?:st|nd|rd|th)\s*round", r"(technical\s+(?:round|interview))", r"(hr\s+(?:round|interview))", r"(coding\s+(?:round|interview|test))", r"(managerial\s+(?:round|interview))",
    r"(aptitude\s+(?:round|test))", r"(system\s+design\s+(?:round|interview))", r"(behavioral\s+(?:round|interview))", r"(phone\s+(?:screen(?:ing)?|round|interview))", r"(onsite\s+(?:round|interview))",
    r"(final\s+(?:round|interview))", r"(group\s+discussion)", r"(pdm\s+(?:round|interview))", r"(culture\s+fit\s+(?:round|interview))", r"(bar\s+raiser\s+(?:round|interview))", r"(hiring\s+manager\s+(?:round|interview))",
]
# How titles name the company, in order.
TITLE_COMPANY = [
    r"(?i)^([\w\s.&\-]+?)\s+Interview\s+Experience", r"(?i)Interview\s+Experience\s+(?:at|with|for)\s+([\w\s.&\-]+?)\s*(?:for|\-|\||$)", r"(?i)(?:My|The)\s+(?:Interview\s+(?:at|with)\s+)?([\w\s.&\-]+?)\s+Interview",
    r"(?i)Interview\s+(?:at|with)\s+([\w\s.&\-]+?)\s*(?:\||\-|$)", r"(?i)(?:Interview\s+Questions\s+(?:from|at)|Hiring\s+Process\s+(?:at|of))\s+([\w\s.&\-]+)", r"(?i)(?:Placed|Selected|Hired)\s+(?:at|by|in)\s+([\w\s.&\-]+)",
]
# Topics of questions and the words that name them.
TOPICS = {
    "dsa": ["dsa", "data structure", "data structures", "algorithm", "algorithms", "binary search", "binary tree", "linked list", "stack", "queue", "heap", "hash map", "hashmap", "hash table", "sorting", "searching", "dynamic programming", "dp", "greedy", "backtracking", "recursion", "graph traversal", "bfs", "dfs", "tree traversal", "sliding window", "two pointer", "two pointers", "array", "string manipulation", "trie", "segment tree", "disjoint set", "union find", "topological sort", "shortest path", "dijkstra", "anagram", "palindrome", "matrix", "grid", "leetcode"],
    "system_design": ["system design", "high level design", "hld", "low level design", "lld", "scalability", "load balancer", "load balancing", "caching", "database design", "schema design", "microservices", "distributed system", "distributed systems", "api design", "rate limiting", "message queue", "pub sub", "sharding", "replication", "consistency", "availability", "cap theorem"],
    "behavioral": ["behavioral", "behaviour", "tell me about yourself", "introduce yourself", "self introduction", "strengths", "weaknesses", "where do you see yourself", "why this company", "why do you want", "conflict resolution", "teamwork", "leadership question", "challenging situation", "biggest achievement", "failure", "career goals"],
    "sql_dbms": ["sql", "dbms", "database", "query", "queries", "join", "normalization", "indexing", "transactions", "acid", "stored procedure", "trigger", "view", "primary key", "foreign key", "relational", "er diagram", "nosql"],
    "os": ["operating system", "operating systems", "cpu scheduling", "process", "thread", "deadlock", "semaphore", "mutex", "virtual memory", "paging", "segmentation", "memory management", "file system", "context switch", "multithreading", "synchronization"],
    "networking": ["networking", "computer network", "tcp", "udp", "http", "https", "dns", "osi model", "ip address", "subnetting", "routing", "firewall", "ssl", "tls", "socket", "rest api"],
    "oop": ["oops", "oop", "object oriented", "object-oriented", "inheritance", "polymorphism", "encapsulation", "abstraction", "design pattern", "design patterns", "solid principles", "singleton", "factory pattern", "interface", "abstract class"],
    "ml_ai": ["machine learning", "deep learning", "neural network", "classification", "regression", "random forest", "decision tree", "svm", "support vector", "gradient descent", "overfitting", "underfitting", "cross validation", "feature engineering", "nlp", "natural language", "computer vision", "cnn", "rnn", "lstm", "transformer", "bert", "gpt", "tensorflow", "pytorch", "llm"],
    "web_dev": ["html", "css", "javascript", "react", "angular", "vue", "node.js", "nodejs", "express", "django", "flask", "spring boot", "rest api", "graphql", "frontend", "backend", "full stack"],
    "aptitude": ["aptitude", "logical reasoning", "verbal reasoning", "quantitative", "puzzle", "puzzles", "brain teaser", "probability", "permutation", "combination"],
}
# Phrases after which a text names the role, in order.
ROLE_TRIGGERS = [
    r"(?:for\s+the\s+)?role\s+(?:of|:)\s+", r"(?:applied|applying)\s+(?:for|as)\s+(?:the\s+)?(?:role\s+of\s+)?", r"interview(?:ed)?\s+for\s+(?:the\s+)?(?:role\s+of\s+)?(?:a\s+)?",
    r"(?:hiring|recruited?)\s+for\s+(?:the\s+)?", r"(?:offered|selected\s+for)\s+(?:the\s+)?(?:role\s+of\s+)?", r"(?:position|designation)\s*:\s*", r"target\s+position\s*:\s*",
]
# Where a chunk of a round begins.
ROUND_STARTS = [
    r"(?:round|interview\s*round)[\s\-]*(?:\d+(?:\s*(?:&|and)\s*\d+)?|[IVXL]+)\s*(?:[:\-\(]|\([^)]*\)\s*:)?", r"(?:zero|first|second|third|fourth|fifth|sixth|seventh)\s*round\s*[:\-\(]?",
    r"(?:hr|human\s*resource)\s*(?:round|interview)\s*[:\-\(]?", r"phone\s*(?:screen|interview)\s*[:\-\(]?", r"online\s*(?:assessment|test)\s*[:\-\(]?", r"(?:oa|written\s*test|aptitude\s*test)\s*[:\-\(]",
    r"technical\s*(?:round|interview)\s*\d*\s*[:\-\(]?", r"coding\s*(?:round|interview)\s*\d*\s*[:\-\(]?", r"system\s*design\s*(?:round|interview)?\s*[:\-\(]?", r"machine\s*coding\s*(?:round)?\s*[:\-\(]?",
    r"behavioral\s*(?:round|interview)\s*[:\-\(]?", r"managerial\s*(?:round|interview)\s*[:\-\(]?", r"final\s*(?:round|interview)\s*[:\-\(]?", r"onsite\s*(?:round|interview)?\s*[:\-\(]?", r"group\s*discussion\s*[:\-\(]?",
    r"superday\s*(?:round|rounds)?\s*[:\-\(]?", r"f2f\s*\d+\s*[:\-]?", r"f\s*2\s*f\s*\d+\s*[:\-]?",
]

# Enumerations of the processed schema, and its required fields.
ENUMS = {
    "experience_level": ["intern", "entry", "mid", "senior", "staff", "leadership", "unknown"],
    "interview_outcome": ["offer", "reject", "pending", "unknown"],
    "difficulty": ["easy", "medium", "hard", "unknown"],
}
# The scalar columns of the processed schema, in order.
TARGET = (
    "document_id source_platform source_url content_hash title content word_count company role experience_level interview_outcome difficulty num_rounds "
    "published_at scraped_at preprocessed_at scrape_batch_id source_metadata"
).split()
# Signs of a paywall in the text of a page, then in the state of its posts.
PAYWALL_TEXTS = [("Member-only badge", r"(?i)Member-only story"), ("Preview text", r"(?i)This is a preview"), ("Paywall CTA", r"(?i)Upgrade to continue|Subscribe to read")]
PAYWALL_STATES = [("Apollo isLocked", "isLocked"), ("Apollo isLockedPreviewOnly", "isLockedPreviewOnly"), ("Apollo isMarkedPaywallOnly", "isMarkedPaywallOnly")]
PAYWALL_CONTENT = 'content({"postMeteringOptions":{"referrer":""}})'
REQUIRED = ["document_id", "source_platform", "source_url", "content_hash", "title", "content", "company", "role"]
