"""Word lists, patterns, prompts and defaults that results depend on."""

from __future__ import annotations

# --- fixed values: categories and word lists of the template generator ---

CATEGORIES = [
    "Software Engineer", "Data Scientist", "Product Manager",
    "Sales Representative", "Marketing Specialist", "HR Manager",
    "UX Designer", "DevOps Engineer", "Business Analyst", "Accountant",
    "Customer Support Agent", "Operations Manager",
]

SKILLS = {
    "Software Engineer": ["Python", "Java", "C++", "JavaScript", "React", "Angular", "Node.js", "Spring Boot", "Django", "Flask", "microservices", "REST APIs", "GraphQL", "Docker", "Kubernetes", "AWS", "Azure", "GCP", "SQL", "NoSQL", "Git", "Agile", "Scrum", "CI/CD pipelines"],
    "Data Scientist": ["Python", "R", "SQL", "Spark", "Hadoop", "machine learning", "deep learning", "NLP", "computer vision", "TensorFlow", "PyTorch", "scikit-learn", "statistics", "data mining", "A/B testing", "Tableau", "PowerBI", "causal inference"],
    "Product Manager": ["roadmapping", "user stories", "agile methodologies", "market analysis", "product strategy", "A/B testing", "JIRA", "Confluence", "stakeholder management", "UX principles"],
    "Sales Representative": ["B2B sales", "B2C sales", "lead generation", "CRM software (Salesforce, HubSpot)", "negotiation", "closing deals", "cold calling", "account management", "sales quotas"],
    "Marketing Specialist": ["digital marketing", "SEO/SEM", "content creation", "social media marketing", "email marketing", "Google Analytics", "PPC campaigns", "brand management", "market research"],
    "HR Manager": ["recruitment", "employee relations", "HRIS systems", "performance management", "compensation and benefits", "labor law", "onboarding", "talent development"],
    "UX Designer": ["Figma", "Sketch", "Adobe XD", "user research", "wireframing", "prototyping", "usability testing", "user personas", "interaction design", "information architecture"],
    "DevOps Engineer": ["CI/CD", "Docker", "Kubernetes", "Terraform", "Ansible", "AWS", "Azure", "GCP", "Linux administration", "scripting (Bash, Python)", "monitoring tools (Prometheus, Grafana)"],
    "Business Analyst": ["requirements gathering", "process mapping", "data analysis", "SQL", "Excel", "UML", "stakeholder communication", "problem-solving", "Agile/Scrum"],
    "Accountant": ["GAAP", "IFRS", "financial reporting", "bookkeeping", "QuickBooks", "SAP", "Excel", "auditing", "tax preparation", "budgeting"],
    "Customer Support Agent": ["Zendesk", "Salesforce Service Cloud", "communication skills", "problem-solving", "empathy", "technical troubleshooting", "multitasking", "de-escalation"],
    "Operations Manager": ["process improvement", "logistics", "supply chain management", "Six Sigma", "Lean principles", "project management", "budget management", "team leadership", "inventory control"],
}

COMPANY_TYPES = ["a fast-growing startup", "a leading enterprise company", "a dynamic scale-up", "an innovative tech firm", "a well-established organization", "a mission-driven non-profit", "a cutting-edge research lab"]
SENIORITY_HINTS = ["an entry-level", "a junior", "a mid-level", "a senior", "a lead", "a staff", "a principal", "an experienced"]
ACTION_VERBS = ["Seeking", "Hiring", "Looking for", "We need", "Opportunity for"]

# --- fixed values: probabilities, defaults and formats of the template generator ---

SKILL_PROBABILITY = 0.6
PREFIX_PROBABILITY = 0.4
SHUFFLE_PROBABILITY = 0.3
TEMPLATE_ROWS_PER_LANGUAGE = 30
LANGUAGES = ["en", "es", "fr"]
SOURCE_LANGUAGE = "en"
GENERIC_TEXT = "Standard job description for a {category}. Key responsibilities involve core {category} tasks and team collaboration. Expertise in {category}-specific tools and methodologies is required."

# --- fixed values: translation ---

MAX_TRANSLATION_ATTEMPTS = 3
THROTTLED = "ThrottlingException"
FIRST_RETRY_WAIT_SECONDS = 2

# --- fixed values: model-response generator ---

RESPONSE_LANGUAGES = {"English": "en", "Spanish": "es", "French": "fr"}
RESPONSE_ROWS_PER_LANGUAGE = 50
ROWS_PER_REQUEST = 5
EXTRA_ATTEMPTS = 3
TOKENS_PER_ROW = 512
TEMPERATURE = 0.75
TOP_P = 0.9
START_MARKER = "--- JD START ---"
END_MARKER = "--- JD END ---"
REQUEST_PROMPT = """You are an expert Human Resources content writer specializing in crafting compelling job descriptions.
Your task is to generate {n} distinct and realistic job descriptions for the role of "{category}" in {language}.

For each job description, please ensure the following:
1.  A clear and concise job title that accurately reflects the "{category}" role.
2.  A brief, engaging introduction to a fictional company. Vary the company type (e.g., tech startup, established corporation, non-profit, e-commerce, financial services, healthcare tech).
3.  A section detailing 3-5 key responsibilities.
4.  A section listing 3-5 essential qualifications or skills. This could include specific technologies, software, years of experience, educational background, or soft skills.
5.  Optionally, a brief mention of company culture or unique benefits.
6.  Vary the overall length of each job description (some shorter, around 100-150 words; some medium, around 150-250 words; and some longer, around 250-350 words).
7.  Vary the tone and style (e.g., some formal and corporate, others more casual and startup-oriented, some highly technical, some more focused on impact).
8.  Ensure each of the {n} job descriptions you generate for this request are significantly different from one another in terms of company, specific responsibilities, and phrasing. Avoid simple rephrasing of the same core points.

Please format your entire response as a single block of text.
Clearly separate each generated job description using the following delimiters:
--- JD START ---
(Job Description Content for JD 1)
--- JD END ---
--- JD START ---
(Job Description Content for JD 2)
--- JD END ---
...and so on for all {n} job descriptions.
Do not include any other text, preamble, or explanation outside of these delimited job descriptions.
"""
REQUEST_WRAPPER = "<s>[INST] {prompt} [/INST]"

# --- fixed values: cleaning patterns and the classification prompt ---

# \w and whitespace are spelt out as Unicode classes: the JVM's \w and \s are ASCII-only.
WORD_CLASS = r"[\p{L}\p{N}_]"
TRANSLATION_MARKER = r"\[[A-Z]{2,}_(?:UNTRANSLATED|NO_TRANSLATE_CLIENT|FAILED_" + WORD_CLASS + r"+|ERROR)\]"
BRACKETED_MARKER = r"\[[A-Z_]+\]"
# The characters that count as whitespace, and the same set as two character classes: Latin-1 characters
# listed one by one (the regex engine tests such a class by table look-up), and the others.
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NARROW_SPACE = r"[\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0]"
WIDE_SPACE = r"[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WIDE_SPACE_RANGE = r"[\u1680-\u3000]"
PROMPT_PREFIX = "Classify the following job description. Job Description: "

# --- fixed values: split, encoding and scoring ---

TEST_FRACTION = 0.15
VALIDATION_FRACTION = 0.15
USER_TURN = "\n\nHuman: "
ASSISTANT_TURN = "\n\nAssistant: "
TOKEN_LIMIT = 512
IGNORED_LABEL = -100
SCORING_BATCH = 4
EXAMPLE_ROWS = 20

# --- fixed values: training-log feed ---

LOG_PATTERNS = {
    "train:loss": r"'loss': ([0-9\.]+)",
    "eval:loss": r"'eval_loss': ([0-9\.]+)",
    "eval:accuracy": r"'eval_accuracy': ([0-9\.]+)",
}
LOG_EVERY_STEPS = 5
REQUIRED_MODEL_FILES = ["config.json", "pytorch_model.bin", "tokenizer.json"]
MODEL_ARCHIVE_SUFFIX = "model.tar.gz"
