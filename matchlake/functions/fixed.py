"""Word lists, lookup tables, patterns and defaults that decide results."""

# Words dropped from token lists.
STOPWORDS = """
a about above after again against all am an and any are aren't as at be because
been before being below between both but by can't cannot could couldn't did didn't
do does doesn't doing don't down during each few for from further get got had hadn't
has hasn't have haven't having he he'd he'll he's her here here's hers herself him
himself his how how's i i'd i'll i'm i've if in into is isn't it it's its itself
let's me more most mustn't my myself no nor not of off on once only or other ought
our ours ourselves out over own same shan't she she'd she'll she's should shouldn't
so some such than that that's the their theirs them themselves then there there's
these they they'd they'll they're they've this those through to too under until up
very was wasn't we we'd we'll we're we've were weren't what what's when when's where
where's which while who who's whom why why's will with won't would wouldn't you you'd
you'll you're you've your yours yourself yourselves
""".split()

# Token shape and word suffixes, longest-match order.
TOKEN_PATTERN = r"[a-z0-9]+(?:-[a-z0-9]+)*"
SUFFIXES = ["ing", "tion", "ment", "ness", "able", "ible", "ful", "less", "ous", "ive", "ly", "er", "ed", "es", "s"]
MIN_STEM = 3

# Title keywords per category; the first category with a hit wins.
TITLE_KEYWORDS = [
    ("Engineering", ["engineer", "developer", "software", "devops", "sre", "backend", "frontend", "fullstack"]),
    ("Information-Technology", ["it ", "system admin", "network", "helpdesk", "cybersecurity", "security analyst"]),
    ("Data Science", ["data scientist", "data analyst", "machine learning", "ml engineer", "ai "]),
    ("Design", ["designer", "ux", "ui ", "graphic", "creative director"]),
    ("Sales", ["sales", "account executive", "business development", "bdr", "sdr"]),
    ("Marketing", ["marketing", "seo", "content strategist", "brand", "growth"]),
    ("Finance", ["finance", "financial", "accountant", "accounting", "cfo", "controller", "auditor"]),
    ("HR", ["human resources", "recruiter", "recruiting", "talent", "hr "]),
    ("Healthcare", ["nurse", "physician", "medical", "clinical", "health", "pharma"]),
    ("Management", ["manager", "director", "vp ", "vice president", "head of", "lead"]),
    ("Consulting", ["consultant", "consulting", "advisory"]),
    ("Education", ["teacher", "professor", "instructor", "educator", "tutor"]),
    ("Legal", ["lawyer", "attorney", "legal", "paralegal", "advocate"]),
    ("Construction", ["construction", "civil engineer", "project engineer", "architect"]),
]
OTHER_CATEGORY = "Other"

# Raw profile category -> posting category.
CATEGORY_MAP = {
    "ENGINEERING": "Engineering",
    "INFORMATION-TECHNOLOGY": "Information-Technology",
    "HR": "HR",
    "SALES": "Sales",
    "FINANCE": "Finance",
    "ACCOUNTANT": "Finance",
    "BANKING": "Finance",
    "HEALTHCARE": "Healthcare",
    "FITNESS": "Healthcare",
    "DESIGNER": "Design",
    "DIGITAL-MEDIA": "Design",
    "ARTS": "Design",
    "ADVOCATE": "Legal",
    "CONSTRUCTION": "Construction",
    "TEACHER": "Education",
    "BUSINESS-DEVELOPMENT": "Sales",
    "CONSULTANT": "Consulting",
    "CHEF": "Other",
    "AVIATION": "Other",
    "APPAREL": "Other",
    "AGRICULTURE": "Other",
    "AUTOMOBILE": "Engineering",
    "BPO": "Other",
    "PUBLIC-RELATIONS": "Marketing",
}

# Category pairs that earn the "marginal" grade.
RELATED_PAIRS = [
    ("Engineering", "Information-Technology"),
    ("Finance", "Consulting"),
    ("Sales", "Marketing"),
    ("Healthcare", "Education"),
    ("Design", "Marketing"),
]

# Field weights and length-normalisation strengths.
JOB_FIELDS = {"title": (3.0, 0.3), "description": (1.0, 0.75)}
RESUME_FIELDS = {"resume_text": (1.0, 0.75)}
K1 = 1.2
MAX_QUERY_TERMS = 64
CANDIDATE_POOL = 100
ALPHA = 0.5
K_VALUES = (5, 10, 20)
RELEVANCE_THRESHOLD = 2
SEED = 42
MIN_JOB_WORDS = 20
MIN_RESUME_WORDS = 30
FALLBACK_WORDS = 10
ENCODE_BATCH = 128

# The link prefix shown next to a match.
SEARCH_LINK = "https://www.linkedin.com/jobs/search/?keywords="

# The judge's instructions; {placeholders} are filled per pair.
JUDGE_PROMPT = """You are an expert recruiter evaluating how well a job posting matches a candidate's resume.

Rate the relevance of this job posting for this resume on a 0-3 scale:
  0 = Not relevant (completely different field or skills)
  1 = Marginally relevant (same broad industry but different role/level)
  2 = Relevant (related skills and field, reasonable match)
  3 = Highly relevant (strong skill overlap, ideal match for the candidate)

RESUME:
{resume_text}

JOB POSTING:
Title: {job_title}
Description: {job_description}

Respond with ONLY a single integer (0, 1, 2, or 3) and nothing else."""

# CSV cells read as missing.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
