"""Lexicons: ordered category -> ordered keyword (or regex) lists, carried as data.

A lexicon is a *bag*: keyword order and duplicates are significant because the
classifiers count hits (a keyword listed twice counts twice) and resolve ties
by declared category order.  Lexicons are small, bounded driver-side constants;
they reach the executors as literal arrays inside expressions (see
``functions.lexicon``) or as a broadcast table (``Lexicon.to_df``), never as
data that grows with the input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Lexicon:
    """Ordered ``category -> keywords`` map.

    ``is_regex``: keywords are regular expressions (case-insensitive search).
    ``lower_keywords``: keywords are lower-cased before the substring test
    (one analyser does this, the other does not -- see ``normalize`` below).
    """

    name: str
    entries: tuple[tuple[str, tuple[str, ...]], ...]
    is_regex: bool = False
    lower_keywords: bool = True
    default: str | None = None
    meta: dict = field(default_factory=dict, compare=False)

    @staticmethod
    def of(name, mapping, **kw) -> "Lexicon":
        return Lexicon(name, tuple((c, tuple(v)) for c, v in mapping.items()), **kw)

    @property
    def categories(self) -> list[str]:
        return [c for c, _ in self.entries]

    def keywords(self, category: str) -> list[str]:
        for c, kws in self.entries:
            if c == category:
                return [k.lower() if (self.lower_keywords and not self.is_regex) else k for k in kws]
        raise KeyError(category)

    def normalized(self) -> "Lexicon":
        """Opt-in mode: lower every keyword (fixes upper-case keywords never matching)."""
        return Lexicon(self.name, tuple((c, tuple(k.lower() for k in v)) for c, v in self.entries),
                       self.is_regex, True, self.default)

    def to_rows(self) -> list[tuple]:
        rows = []
        for ci, (c, kws) in enumerate(self.entries):
            for ki, k in enumerate(kws):
                kk = k.lower() if (self.lower_keywords and not self.is_regex) else k
                rows.append((self.name, c, ci, ki, kk, self.is_regex))
        return rows

    def to_df(self, spark: SparkSession) -> DataFrame:
        """Table form ``(dimension, category, cat_rank, kw_rank, keyword, is_regex)``."""
        return spark.createDataFrame(self.to_rows(), LEXICON_SCHEMA)


LEXICON_SCHEMA = T.StructType([
    T.StructField("dimension", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("cat_rank", T.IntegerType(), False),
    T.StructField("kw_rank", T.IntegerType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("is_regex", T.BooleanType(), False),
])


# ---------------------------------------------------------------------------
# Must equal the reference analysers' lists for equal results.
# Written out as data in their declared order (order and duplicates matter).
# ---------------------------------------------------------------------------

# Pain-point categories (regex, case-insensitive search, first hit per category).
PAIN_CATEGORIES = {
    "Marketing Effectiveness Collapse": [
        r"(?:marketing|ads|advertising|promotion|campaign|social media|facebook ads|google ads|ROAS|conversion)",
        r"(?:media buyer|digital marketing|growth marketing|lead generation)",
    ],
    "Payment Processing Barriers": [
        r"(?:payment gateway|payment processor|stripe|paypal|fawry|paymob|visa|mastercard)",
        r"(?:banking|credit card|debit card|transaction|settlement|payout)",
        r"(?:دفع|بوابة دفع|تحويل بنكي|بطاقة ائتمان)",
    ],
    "Finding Technical Talent": [
        r"(?:developer|programmer|software engineer|frontend|backend|full stack|mobile app|ios|android)",
        r"(?:co.?founder|CTO|technical.?founder|tech.?lead|software.?house)",
        r"(?:مطور|مبرمج|مهندس برمجيات|تطبيق|موبايل)",
        r"(?:talent|team building|hiring|recruitment|outsourcing)",
    ],
    "Customer Acquisition": [
        r"(?:customer acquisition|get clients|find customers|sales|leads|prospects)",
        r"(?:عميل|عملاء|مبيعات|عميل جديد|استقطاب عملاء)",
    ],
    "Cash Flow Management": [
        r"(?:cash flow|working capital|funding|investment|investor|capital|revenue)",
        r"(?:cashflow|liquidity|bootstrapping|self.?funded|profitable)",
        r"(?:تدفق نقدي|رأس مال|تمويل|مستثمر|استثمار)",
    ],
    "WhatsApp Automation Issues": [
        r"(?:whatsapp|wa|واتساب) (?:api|automation|bot|business|integration)",
        r"(?:chatbot|messaging|broadcast|bulk message)",
        r"(?:حظر|block|ban|restriction|limit)",
    ],
    "CRM Implementation Challenges": [
        r"(?:CRM|customer relationship management|customer database|client management)",
        r"(?:customer retention|churn|loyalty|lifecycle)",
        r"(?:إدارة علاقات العملاء|قاعدة بيانات|احتفاظ بالعملاء)",
    ],
    "Legal & Compliance Barriers": [
        r"(?:legal|compliance|regulation|license|permit|trademark|copyright)",
        r"(?:tax|taxation|vat|income tax|corporate tax|filing)",
        r"(?:company formation|incorporation|LLC|entity|structure)",
        r"(?:legal|قانوني|ترخيص|سجل تجاري|بطاقة ضريبية|ضريبة)",
    ],
    "Pricing Strategy Confusion": [
        r"(?:pricing|price strategy|pricing model|monetization|revenue model)",
        r"(?:how much to charge|price point|affordable|expensive|cheap)",
        r"(?:تسعير|استراتيجية التسعير|كم أبيع|السعر المناسب)",
    ],
    "Marketing Automation Needs": [
        r"(?:marketing automation|email marketing|automation tools|workflow|funnel)",
        r"(?:sequenced? email|drip campaign|lead nurturing)",
        r"(?:automate|scale|growth hack)",
    ],
    "Finding Product-Market Fit": [
        r"(?:product.?market fit|PMF|validation|market research|customer discovery)",
        r"(?:mvp|minimum viable product|prototype|testing|feedback)",
        r"(?:دراسة جدوى|تحقيق المنتج مع السوق|MVP|بروتوتايب)",
    ],
    "International Business Expansion": [
        r"(?:international|global|expansion|export|foreign market|cross.?border)",
        r"(?:Gulf|Saudi|UAE|Kuwait|Qatar|Bahrain|Oman)",
        r"(?:الخليج|السعودية|الإمارات|الكويت|قطر|البحرين|عمان)",
        r"(?:currency exchange|multi.?currency|USD|EUR|GBP)",
    ],
    "Team Management Difficulties": [
        r"(?:team management|employee management|HR|human resources|remote team)",
        r"(?:productivity|time tracking|performance management|KPI)",
        r"(?:إدارة الفريق|الموظفين|الإنتاجية|تتبع الوقت)",
    ],
    "Customer Retention Issues": [
        r"(?:customer retention|customer loyalty|repeat purchase|lifetime value|CLV)",
        r"(?:churn rate|retention rate|customer satisfaction|NPS)",
        r"(?:احتفاظ بالعميل|ولاء العملاء|قيمة العميل|معدل التسرب)",
    ],
    "Technical Implementation": [
        r"(?:technical implementation|integration|API|SDK|plugin|extension)",
        r"(?:web development|app development|software development|coding)",
        r"(?:تنفيذ تقني|تطوير برمجي|دمج|واجهة برمجة)",
    ],
    "Business Operations Inefficiencies": [
        r"(?:operations|operational efficiency|process|workflow|SOP|procedures)",
        r"(?:scalability|scaling|growth pains|growing pains)",
        r"(?:العمليات|الكفاءة التشغيلية|الإجراءات|العمليات)",
    ],
    "Funding & Capital Access": [
        r"(?:funding|capital|investment|fundraising|venture capital|angel investor)",
        r"(?:grant|loan|debt financing|equity|valuation)",
        r"(?:تمويل|قرض|استثمار|رأس مال|منحة|صندوق)",
    ],
    "Social Media Marketing Effectiveness": [
        r"(?:social media|Instagram|Facebook|LinkedIn|Twitter|TikTok|content marketing)",
        r"(?:influencer|content creator|brand awareness|engagement)",
        r"(?:سوشيال ميديا|إنستجرام|فيسبوك|لينكد إن|محتوى|مؤثر)",
    ],
    "Sales Process Optimization": [
        r"(?:sales process|sales funnel|pipeline|deal closing|conversion rate)",
        r"(?:B2B sales|enterprise sales|consultative selling|sales training)",
        r"(?:عملية البيع|قمع المبيعات|إغلاق الصفقة|معدل التحويل)",
    ],
    "Data Management & Analytics": [
        r"(?:data analytics|business intelligence|reporting|dashboard|metrics)",
        r"(?:Google Analytics|data visualization|KPI|performance tracking)",
        r"(?:تحليل البيانات|تقارير|مقاييس الأداء|لوحة تحكم)",
    ],
}

# Severity word lists (substring test on lower-cased text; keywords used as written).
URGENCY_KEYWORDS = [
    "urgent", "help", "need", "problem", "issue", "challenge",
    "struggling", "stuck", "blocked", "can't", "unable",
    "please", "desperately", "asap", "immediately", "emergency",
    "حاجة", "مشكلة", "عاجل", "محتاج", "عندى مشكلة",
    "فشل", "عاطل", "توقفت", "ما بيرفعش", "مشتغلش",
]
SEVERITY_KEYWORDS = [
    "critical", "severe", "major", "serious", "breaking",
    "disaster", "catastrophe", "emergency", "crisis",
    "خطير", "حرج", "كارثة", "أزمة", "انهيار",
]

# Business segment indicators (keywords used as written; upper-case ones never
# match lower-cased text in reference mode).
SEGMENT_INDICATORS = {
    "freelancer": [
        "freelancer", "freelance", "self-employed", "solo", "independent",
        "freelance", "أعمل حر", "فريلانسر", "مستقل", "عمل خاص",
    ],
    "startup": [
        "startup", "startup", "founder", "co-founder", "venture",
        "MVP", "product-market fit", "seed stage", "pre-seed",
        "ستارت أب", "مؤسس", "مؤسس مشارك", "مرحلة MVP",
    ],
    "sme": [
        "SME", "small business", "medium business", "company", "established",
        "years in business", "existing business", "ongoing business",
        "شركة", "بيزنس قائم", "لنا سنوات خبرة", "عملنا",
    ],
}
SEGMENTS = ["freelancer", "startup", "sme"]

# Ordinal scales (declared order = index used by scoring and fixed-domain grids).
BUSINESS_STAGES = ["Idea Stage", "MVP/Validation Stage", "Growth Stage", "Established/SME"]
BUSINESS_TYPES = ["Freelancer/Solo", "Startup (Seed/Series A)", "SME (Established)", "Agency/Service Business"]
INDUSTRIES = ["Technology/SaaS", "Marketing & E-commerce", "EdTech", "HealthTech",
              "Construction/Real Estate", "Food & Beverage", "Manufacturing/Export",
              "Professional Services", "Other"]
TARGET_MARKETS = ["Egypt Only", "GCC", "International/Global", "Regional MENA"]
TECH_LEVELS = ["Non-technical", "Technical", "Developer"]
BUDGET_RANGES = ["$0-$500", "$500-$2K", "$2K-$10K", "$10K+"]

# Demographic keyword lexicons (keywords lower-cased, substring test, duplicates count).
STAGE_PATTERNS = {
    "Idea Stage": [
        "فكرة", "فكره", "idea", "ابدأ", "ابدء", "بدء", "بداية", "مبتدئ",
        "مشروع جديد", "نفس أبدأ", "طلع بمشروع", "بفكر أبدأ",
        "استارت اب", "startup", "فكرتي", "الفكرة", "مشروع استارت اب",
        "أنا بتخرج", "fresh graduate", "تخرجت", "دراسة مبدأية", "دراسة جدوى",
    ],
    "MVP/Validation Stage": [
        "mvp", "إم في بي", "تجربة", "تست", "test", "validation",
        "دراسة جدوى", "أنا بعمل دراسة", "عملت دراسة",
        "نستكمل", "استمرار", "التكلفة", "رأس مال", "capital",
        "أفكار جديدة", "أحب أطلع بمشروع", "مطلوب", "محتاج",
        "شريك", "co-founder", "فريق", "team", "توظيف", "hire",
    ],
    "Growth Stage": [
        "سيريس", "series", "seed", "fund", "funding", "استثمار",
        "مستثمر", "investor", "ترقيم", "scaling", "scale",
        "نمو", "growth", "زبائن", "عملاء", "customers",
        "أدخل فلوس", "ربح", "profit", "sales", "مبيعات",
    ],
    "Established/SME": [
        "سيمي", "smes", "شركة", "شركات", "company", "companies",
        "مؤسسة", "established", "سنوات", "years", "خبرة",
        "قائمة", "قائم", "running", "عملت", "أعمل", "نشاط",
        "مصنع", "factory", "مصانع", "تاجر", "تجار", "business",
    ],
}
TYPE_PATTERNS = {
    "Freelancer/Solo": [
        "فري لانسر", "freelancer", "freelancing", "عمل حر",
        "فريلانسر", "أعمل لوحدي", "مستقل", "solo",
        "شخص واحد", "منفرد", "individual", "own business",
    ],
    "Startup (Seed/Series A)": [
        "استارت أب", "startup", "سيريس", "series", "seed",
        "ترقيم", "fundraising", "مستثمر", "investor",
        "شركة ناشئة", "شركة ناشئه", "co-founder", "شريك",
        "برنامج", "app", "تطبيق", "software", "منصة", "platform",
    ],
    "SME (Established)": [
        "سيمي", "sme", "مؤسسة", "شركة", "شركات",
        "تجارة", "تجار", "متاجر", "store", "stores",
        "مصنع", "factory", "خدمات", "business", "enterprise",
    ],
    "Agency/Service Business": [
        "وكالة", "agency", "خدمات", "service", "consulting",
        "استشارات", "marketing agency", "خدمة", "استشارة",
        "فرش خدمات", "خدمات برمجية", "استشارات إدارية",
    ],
}
INDUSTRY_PATTERNS = {
    "Technology/SaaS": [
        "ساس", "saas", "software", "برنامج", "برمجيات",
        "تطبيق", "app", "منصة", "platform", "tech",
        "تكنولوجيا", "تقنية", "ai", "ذكاء اصطناعي", "artificial intelligence",
        "crm", "erp", "system", "نظام", "automation", "أتمتة",
    ],
    "Marketing & E-commerce": [
        "ماركتنج", "marketing", "تسويق", "دعاية", "advertisement",
        "أونلاين", "online", "تجارة إلكترونية", "e-commerce", "سوشيال ميديا",
        "social media", "ads", "إعلانات", "branding", "متجر", "store",
    ],
    "EdTech": [
        "تعليم", "education", "مدارس", "schools", "جامعة", "university",
        "دورات", "courses", "تعليم إلكتروني", "e-learning",
        "منصة تعليمية", "تدريس", "تعليمي",
    ],
    "HealthTech": [
        "صحة", "health", "طبي", "medical", "عيادات", "clinics",
        "دكاترة", "doctors", "hospital", "مستشفى", "medtech",
    ],
    "Construction/Real Estate": [
        "عقار", "real estate", "مقاولات", "construction", "بناء",
        "شقق", "apartments", "مباني", "buildings", "مشروع عقاري",
    ],
    "Food & Beverage": [
        "طعام", "food", "مطعم", "restaurant", "مشروبات", "beverages",
        "أكل", "كافيه", "cafe", "غذاء",
    ],
    "Manufacturing/Export": [
        "تصنيع", "manufacturing", "تصدير", "export", "مصنع",
        "factory", "إنتاج", "production", "تصنيعي",
    ],
    "Professional Services": [
        "محاسبة", "accounting", "قانوني", "legal", "ضريبة", "tax",
        "استشارات", "consulting", "خدمات مهنية", "خدمة مهنية",
    ],
}
MARKET_PATTERNS = {
    "Egypt Only": [
        "مصر", "egypt", "السوق المصري", "محلي", "local",
        "في مصر", "القاهرة", "cairo", "الاسكندرية", "alexandria",
    ],
    "GCC": [
        "الخليج", "gcc", "السعودية", "saudi", "سعودية",
        "الامارات", "uae", "دبي", "dubai", "قطر", "qatar",
        "الكويت", "kuwait", "عمان", "oman", "بحرين", "bahrain",
    ],
    "International/Global": [
        "جلوبال", "global", "عالمي", "international", "global",
        "سوق عالمي", "خارج مصر", "خارج", "دولي", "أمريكا", "usa",
        "أوروبا", "europe", "بريطانيا", "uk",
    ],
    "Regional MENA": [
        "منطقة", "region", "شرق أوسط", "middle east", "mena",
        "المنطقة العربية", "العالم العربي", "إقليمي", "regional",
    ],
}
TECH_PATTERNS = {
    "Non-technical": [
        "مش فاهم", "مش عارف", "أحتاج مبرمج", "أحتاج مطور",
        "ما عنديش خبرة", "أبتدئ", "أحتاج مساعدة", "كيف أعمل",
        "أحتاج توضيح", "مبتدئ",
    ],
    "Technical": [
        "مبرمج", "programmer", "developer", "مطور",
        "معرفة برمجة", "خبرة تقنية", "tech stack", "تقني",
        "كود", "code", "backend", "frontend",
    ],
    "Developer": [
        "أعمل برمجة", "developer", "software engineer", "كتابة كود",
        "سورس كود", "source code", "github", "git",
        "full stack", "backend developer", "frontend developer",
    ],
}
# Budget keyword lexicon: the regex-looking entries are matched as literal
# substrings in reference mode (they practically never hit).
BUDGET_PATTERNS = {
    "$0-$500": [
        r"\d+ جنيه", r"\d+ EGP", r"\d+ egp", "أقل من 500",
        "ميزانية قليلة", "ميزانية محدودة", "budget.*low",
    ],
    "$500-$2K": [
        r"(\d{3,4}) جنيه", r"(\d{3,4}) EGP", r"(\d{3,4}) egp",
        "ألف", r"\d+K", "كيلو", "بضعة آلاف",
    ],
    "$2K-$10K": [
        r"(\d{4,5}) جنيه", r"(\d{4,5}) EGP",
        "آلاف", "عشرات الآلاف", r"\d+,\d+", "عشرة آلاف",
    ],
    "$10K+": [
        r"(\d{6,}) جنيه", r"(\d{6,}) EGP", "ملايين",
        "مليون", "million", r"\d+M", "ميزانية كبيرة", "استثمار",
    ],
}
# Amount-with-currency rule of the budget extractor, and its bucket edges.
BUDGET_AMOUNT_PATTERN = r"(\d+)\s*(جنيه|EGP|egp|\$)"
BUDGET_EDGES = [500, 2000, 10000]

PAIN_POINT_PATTERNS = {
    "Technical/Technical Implementation": [
        "أحتاج مبرمج", "مش عارف أبرمج", "أحتاج تطوير",
        "كيف أعمل تطبيق", "تكلفة برمجة", "برمجة", "programming",
        "technical issues", "مشاكل تقنية", "bugs", "أخطاء",
    ],
    "Marketing/Sales": [
        "زبائن", "عملاء", "customers", "marketing", "تسويق",
        "إعلانات", "ads", "مبيعات", "sales", "lead generation",
        "بيع", "selling", "توسع", "scaling",
    ],
    "Financial/Funding": [
        "تمويل", "funding", "مستثمر", "investor", "رأس مال",
        "capital", "استثمار", "investment", "ضريبة", "tax",
        "حساب بنكي", "bank account", "wise", "transfer",
    ],
    "Operations/Management": [
        "إدارة", "management", "فريق", "team", "توظيف",
        "hiring", "coo", "operations", "workflow", "workflow automation",
        "تنظيم", "organization", "أتمتة", "automation",
    ],
    "Legal/Regulatory": [
        "ترخيص", "license", "ضريبي", "tax", "ضرائب",
        "قانوني", "legal", "تأسيس شركة", "registration",
        "رقم ضريبي", "uin",
    ],
    "Customer Service/Support": [
        "خدمة عملاء", "customer service", "support", "دعم فني",
        "cr", "crm", "واتساب", "whatsapp", "تواصل مع العملاء",
    ],
}
TOOL_PATTERNS = {
    "CRM/WhatsApp": ["crm", "whatsapp", "wa", "واتساب", "3rab.cash"],
    "Payment Processing": ["fawry", "vodafone cash", "transfer", "payment"],
    "Marketing Tools": ["facebook ads", "google ads", "social media", "ads"],
    "Development Tools": ["github", "git", "code", "programming"],
    "Communication": ["zoom", "meet", "call", "meeting"],
    "Accounting/Finance": ["wise", "bank", "accounting", "tax"],
}

# Scoring weights of the readiness score and the average-budget thresholds.
READINESS_WEIGHTS = {
    "budget": 15, "tech_capability": 15, "implementation_capability": 15,
    "willingness_to_pay": 15, "pain_tolerance": 15, "tool_adoption": 10,
    "business_stage": 15,
}
BUDGET_AVG_THRESHOLDS = [1.5, 2.5, 3.5]
# Team size labels by business type.
TEAM_SIZE = {
    "solo": "1 person", "startup_small": "2-5 people", "startup_large": "5-10 people",
    "sme": "10-50 people", "agency": "5-20 people", "unknown": "Unknown",
}
# Engagement keyword-count severity formula constants: 3 + 1.5*urgency + 2*severity, capped at 10.
SEVERITY_BASE, SEVERITY_URGENCY_W, SEVERITY_SEVERITY_W, SEVERITY_CAP = 3.0, 1.5, 2.0, 10
# Length buckets of the quality report and the truncation markers.
LENGTH_SHORT_BELOW, LENGTH_LONG_FROM = 100, 300
TRUNCATION_MARKERS = ["See more", "عرض المزيد"]
# Report sizes.
TOP_TAGS, TOP_PER_SEGMENT, SAMPLE_POSTS, TOP_LONGEST = 20, 5, 20, 5
# End of fixed values.
# ---------------------------------------------------------------------------


def pain_lexicon() -> Lexicon:
    return Lexicon.of("pain", PAIN_CATEGORIES, is_regex=True, lower_keywords=False)


def segment_lexicon() -> Lexicon:
    # keywords are NOT lower-cased (reference behaviour, see Lexicon.normalized)
    return Lexicon.of("segment", SEGMENT_INDICATORS, lower_keywords=False, default="unknown")


DEMOGRAPHIC_DIMENSIONS = {
    "business_stage": STAGE_PATTERNS,
    "business_type": TYPE_PATTERNS,
    "industry": INDUSTRY_PATTERNS,
    "target_market": MARKET_PATTERNS,
    "tech_level": TECH_PATTERNS,
}


def demographic_lexicons() -> dict[str, Lexicon]:
    return {k: Lexicon.of(k, v) for k, v in DEMOGRAPHIC_DIMENSIONS.items()}


def budget_lexicon() -> Lexicon:
    return Lexicon.of("budget_range", BUDGET_PATTERNS)


def pain_point_lexicon() -> Lexicon:
    return Lexicon.of("pain_points", PAIN_POINT_PATTERNS)


def tool_lexicon() -> Lexicon:
    return Lexicon.of("tool_preferences", TOOL_PATTERNS)


# A probe lexicon of our own, built from words that do occur in the driver's
# synthetic documents, so tag statistics are not vacuous on the test tables.
PROBE_TAGS = {
    "license": ["license"],
    "romance": ["ción", "mente", "les "],
    "german": ["heit", "ichen", "der "],
    "english": ["the ", "thand"],
    "suffixes": ["test", "tionment"],
}


def probe_lexicon(regex: bool = True) -> Lexicon:
    return Lexicon.of("probe", PROBE_TAGS, is_regex=regex, lower_keywords=not regex)
