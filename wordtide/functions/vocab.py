"""Word lists, shares, patterns and thresholds that results depend on."""

from __future__ import annotations

# Fixed values, in the order in which rules look at them.
LEGACY_TERMS = (
    "calculator converter generator checker tracker planner invoice subtitle transcript compress resize remove "
    "background pdf csv json markdown diagram audio video image photo prompt agent schema recipe itinerary resume "
    "flashcard chord sheet font palette mockup watermark screenshot timezone pronunciation worksheet timer countdown "
    "qr barcode"
).split()
EXTRA_TERMS = (
    "check translate translation summarize summary transcribe extract editor maker merge split optimize optimizer "
    "convert calculate budget tax booking schedule calendar learn study tutor quiz practice verification verify "
    "validation validate governance permission observability compliance audit monitor workflow automate automation "
    "receipt expense nutrition calorie workout meal gardening seedling sprite pixel vector heic avif webp exif favicon "
    "encrypt decrypt password redact anonymize accessibility contrast sitemap robots diff regex formatter validator "
    "roadmap mindmap whiteboard synthesize speech voice podcast caption"
).split()
ROOTS = (
    "translator generator example convert online downloader maker creator editor processor designer compiler analyzer "
    "evaluator sender receiver interpreter uploader calculator sample template format builder scheme pattern checker "
    "detector scraper manager explorer dashboard planner tracker recorder optimizer scheduler converter viewer "
    "extractor monitor notifier verifier simulator assistant constructor comparator navigator syncer connector "
    "cataloger responder"
).split()
BROAD_ROOTS = ("online", "example", "sample", "format", "scheme", "pattern")
STOP_WORDS = (
    "a an the and or for with from by of your our their my to is are be get use create build best free top easy simple "
    "powerful ultimate instant professional welcome official home website site tool tools"
).split()
BOUNDARY_WORDS = "with your our the best free use using get is are".split()
RIGHT_EXTENDING = ("online", "convert", "example", "sample")
SHELL_PHRASES = (
    "home", "homepage", "welcome", "about us", "contact us", "sign in", "log in", "login", "privacy policy", "terms of service",
)
#: (channel, share of the quota), in order.
CHANNELS = (("legacy_terms", 50), ("expanded_terms", 25), ("name_exploration", 20), ("unrestricted_exploration", 5))
#: (group, share, suffixes); the one without suffixes takes the rest.
SUFFIX_GROUPS = (
    ("traditional", 45, ("com", "net", "org")),
    ("product_technology", 25, ("ai", "io", "app", "dev", "tech")),
    ("other_common", 20, ("co", "me", "cc", "tv")),
    ("remaining", 10, ()),
)
# Page patterns, as regular expressions of Java and Python alike.
CHALLENGE = (
    r"just a moment|access denied|verify (?:that )?you are human|checking your browser|security verification|"
    r"attention required|验证码|人机验证"
)
PARKED = r"(?:this |the )?domain (?:name )?(?:is )?(?:for sale|parked)|buy this domain|domain parking|域名出售|此域名正在出售"
PLACEHOLDER = (
    r"coming soon[.!…]*|under construction[.!…]*|welcome to nginx[.!]*|apache2? (?:\w+ )?default page|"
    r"default (?:web ?site|page)|index of /.*|网站建设中[！。]*|即将上线[！。]*"
)
SOFT_404 = r"(?:404\s*[-:|]?\s*)?(?:page )?not found[.!]*|404|页面不存在"
GENERIC_HEADING = (
    r"(?:home|homepage|welcome|coming soon|just a moment|access denied|error|untitled|index|loading|sign in|log in|404|403|首页|欢迎|登录)[.!…\s]*"
)
# Page patterns of the monthly probe, which has its own.
PROBE_PARKED = (
    r"\b(?:domain (?:is )?for sale|buy this domain|this domain (?:is )?(?:parked|available)|domain parking|website (?:is )?coming soon|"
    r"under construction|account suspended|website expired|domain (?:has )?expired|default (?:web ?site|page)|welcome to nginx|"
    r"apache2? .*default page|future home of|index of /)\b|域名出售|网站建设中|即将上线"
)
PROBE_UNOPENED = r"(?:coming soon|under construction|即将上线|网站建设中)[.!…\s]*"
PROBE_SOFT_ERROR = r"\bpage (?:was )?not found\b|^(?:not found|404 error|404(?:\s*[-|:—]\s*(?:page|not)|\s+(?:page|not found)|$))"
PROBE_CHALLENGE = (
    r"^(?:just a moment|access denied|attention required|verify you are human|checking your browser|security verification|please wait)"
)
# Headings that a later review corrects, as whole texts: (pattern, decision, reason), in the order in which they count.
REVIEW_RULES = (
    (r"security check|client challenge|confirm you are human|verify you are human|robot or human\??", "recheck", "review_challenge"),
    (
        r"namecheap parking page|parked domain name on hostinger dns system|domain registered at whc\.ca|domain parking|"
        r"(?:[a-z0-9.-]+\.[a-z]{2,}) (?:is )?for sale(?:\s*[|–—].*)?",
        "skip", "review_parking",
    ),
    (
        r"coming soon[.!…]*|launching soon[.!…]*|site en construction|domain default page|site is created successfully!|"
        r"новый сайт успешно создан и готов к работе|エックスサーバー サーバー初期ページ|webcake\s*[|]\s*chưa xuất bản|"
        r"sorry, the website has been stopped|website is online|.*\s[–—-]\scoming soon|website [a-z0-9.-]+ is ready\. the content is to be added",
        "skip", "review_placeholder",
    ),
)
# Phrases that promote instead of naming a use.
MARKETING = (
    r"\b(?:complete guide|ultimate guide|essential guide|your guide|grow organic traffic|boosting online visibility|"
    r"maximizing online visibility|unlocking|grow your|boost your|our online|your online|toggle menu|sign up|sign in|log in|contact us|"
    r"cookie policy|privacy policy|terms of service)\b"
)
GENERIC_TERMS = (
    "online presence", "online visibility", "authority online", "online success", "online experience", "online business", "online journey", "online world",
)
# Thresholds.
THIN_TEXT, SHORT_TEXT, PARKED_TEXT = 160, 800, 1200
FIELD_CAPS = {"title": 600, "description": 1500, "og_description": 1500, "h1": 600, "visible_text": 3000}
MOST_HEADINGS = 10
PACING = {"interval": 45, "first_cooldown": 3600, "longest_cooldown": 86400, "healthy_before_reset": 6}
