"""Word lists, paths and patterns that results depend on, as plain text in their natural order."""

STOP_WORDS = "the is and of to in for with that this are was has have been will from not but they their which about more".split()

SEED_PATHS = """
/about about
/about-us about
/company about
/who-we-are about
/products products
/solutions products
/platform products
/services products
/press press
/press-releases press
/media press
/newsroom press
/news news
/blog news
/partners partners
/affiliates partners
/careers careers
/jobs careers
/contact contact
/contact-us contact
/investors investors
/investor-relations investors
/resources resources
/case-studies resources
/responsible-gaming compliance
/responsible-gambling compliance
/licenses compliance
/regulatory compliance
"""

BOILERPLATE_PHRASES = """
we use cookies
this website uses cookies
cookie policy
accept all cookies
manage cookie preferences
manage preferences
by continuing to browse
we use cookies to improve
cookie settings
accept cookies
reject all cookies
this site uses cookies
privacy policy
data protection
your privacy choices
gdpr
personal data
consent to the use
update your preferences
manage your privacy
subscribe to our newsletter
sign up for updates
enter your email
get the latest news
join our mailing list
subscribe now
stay up to date
sign up for our newsletter
unsubscribe at any time
follow us on
share this
tweet this
share on facebook
share on twitter
share on linkedin
pin it
skip to content
skip to main content
toggle navigation
back to top
scroll to top
all rights reserved
terms and conditions
terms of service
terms of use
"""

TRACKING_PARAMS = "utm_source utm_medium utm_campaign utm_term utm_content fbclid gclid gclsrc dclid msclkid mc_cid mc_eid ref referrer _ga _gl _hsenc _hsmi trk trkCampaign sc_campaign sc_channel".split()

JUNK_EXTENSIONS = r"\.(png|jpg|jpeg|gif|svg|webp|ico|pdf|zip|mp4|mp3|woff2?|ttf|eot|css|js)$"
JUNK_PATHS = "/cdn-cgi/ /wp-content/uploads/ /wp-includes/ /wp-json/ /feed/ /xmlrpc.php /wp-login /cart /checkout /my-account /wp-admin".split()

BLOCK_PAGE_MARKERS = """
why have i been blocked
cloudflare ray id
this website is using a security service
action you just performed triggered the security solution
you can email the site owner to let them know you were blocked
attention required
"""

EXCLUDED_TITLES = "cookie privacy terms login 404 cart checkout".split()
EXCLUDED_URLS = "/tag/ /author/ /page/ /category/ /wp-admin/".split()

#: One pattern a line; those after the empty line are matched with case.
CLAIM_PATTERNS = r"""
\b\d+(?:\.\d+)?\s*(?:million|billion|trillion)\b
\bUSD\s*\d+
\bEUR\s*\d+
\bGBP\s*\d+
\bfounded\s+in\s+\d{4}\b
\bestablished\s+in\s+\d{4}\b
\blaunched\s+in\s+\d{4}\b
\bsince\s+\d{4}\b
\bheadquartered\s+in\b
\bbased\s+in\b
\bemploys?\s+(?:over\s+|more\s+than\s+|approximately\s+)?\d
\b\d+\s+employees?\b
\blicensed?\s+(?:by|in|from)\b
\bregulated\s+by\b
\bacquired\s+(?:by|for)\b
\bmerged\s+with\b
\bpartnership\s+with\b
\bsponsors?\s+(?:of|the)\b

\b\d{1,3}(?:,\d{3})+\b
\b\d+(?:\.\d+)?\s*%
\$\s*\d+
\b€\s*\d+
\b£\s*\d+
\bin\s+\d{4}\b
"""

GENERAL_KNOWLEDGE_PATTERNS = r"""
\bigaming\s+is\b
\bonline\s+gambling\s+is\b
\bthe\s+industry\s+(?:is|has|continues)\b
\bglobally\b
\bgenerally\s+(?:speaking|considered)\b
\bit\s+is\s+(?:widely|commonly|generally)\b
\bas\s+(?:one\s+of\s+)?the\s+(?:largest|biggest|most)\b
"""

#: Stems of those patterns that match without a digit.
CLAIM_STEMS = "headquartered based licens regulated acquired merged partnership sponsor".split()

#: What sentence splitting strips, in order: a mark without which the pattern can't match, pattern and replacement.
MARKDOWN_MARKS = [
    ("#", r"(?m)^#+\s+.*$", ""),
    ("---", r"(?m)^---+$", ""),
    (">", r"(?m)^>\s+", ""),
    ("**", r"\*\*([^*]+)\*\*", "$1"),
    ("*", r"\*([^*]+)\*", "$1"),
    ("`", r"`[^`]+`", ""),
    ("```", r"```[\s\S]*?```", ""),
    ("](", r"\[([^\]]+)\]\([^)]+\)", "$1"),
    ("-", r"(?m)^-\s+", ""),
    (".", r"(?m)^\d+\.\s+", ""),
]
ABBREVIATIONS = [("Dr.", "Dr"), ("Mr.", "Mr"), ("Ms.", "Ms"), ("Inc.", "Inc"), ("Ltd.", "Ltd"), ("Co.", "Co"), ("vs.", "vs"), ("e.g.", "eg"), ("i.e.", "ie"), ("etc.", "etc"), ("No.", "No")]


#: Paths of pages that a crawl goes into.
KEY_PAGES = "/blog /news /about /press /partners /articles /insights /media /resources /company".split()

#: What an archive says of pages it hasn't got.
NOT_ARCHIVED = """
Wayback Machine has not archived that URL
This URL has been excluded from the Wayback Machine
"""

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
JOB_VARIANTS = "generic igaming cmo cpo ceo startup digital".split()

#: Signs of a bot check in a page that a browser got.
CHALLENGE_MARKERS = """
cf-browser-verification
Checking your browser
Just a moment...
cf-challenge-running
Attention Required! | Cloudflare
_cf_chl_opt
"""

#: Logo rules: where to look, pattern, points.
LOGO_SIGNS = [("any", "logo", 10), ("any", "brand", 5), ("src", r"\.svg", 5), ("src", "dark|black|primary|colored", 5), ("src", "horizontal|wide|full", 3), ("src", "white|light|reversed|inverted", -5), ("src", r"favicon\.ico$", -5)]

#: Main regions of common content systems, in the order in which they are tried.
REGIONS = [
    r'(?is)<div[^>]+class="[^"]*\bentry-content\b[^"]*"[^>]*>(.*?)</div>',
    r'(?is)<div[^>]+class="[^"]*\bpost-content\b[^"]*"[^>]*>(.*?)</div>',
    r'(?is)<div[^>]+class="[^"]*\bpage-content\b[^"]*"[^>]*>(.*?)</div>',
    r'(?is)<div[^>]+class="[^"]*\belementor-widget-text-editor\b[^"]*"[^>]*>(.*?)</div>\s*</div>',
    r'(?is)<div[^>]+class="[^"]*\belementor-widget-theme-post-content\b[^"]*"[^>]*>(.*?)</div>\s*</div>',
    r'(?is)<div[^>]+data-widget_type="text-editor[^"]*"[^>]*>(.*?)</div>\s*</div>',
    r"""(?is)<[^>]+role=["']main["'][^>]*>(.*?)</[a-z]+>""",
    r'(?is)<div[^>]+class="[^"]*\bcontent-area\b[^"]*"[^>]*>(.*?)</div>',
    r'(?is)<div[^>]+class="[^"]*\bsite-content\b[^"]*"[^>]*>(.*?)</div>',
    r"""(?is)<div[^>]+id=["']content["'][^>]*>(.*?)</div>""",
]


#: Elements that hold a page's text in content systems, in the order in which they are tried.
CMS_SELECTORS = """
.entry-content
.post-content
.page-content
.wp-block-post-content
.elementor-widget-text-editor .elementor-widget-container
.elementor-widget-theme-post-content .elementor-widget-container
[data-widget_type^="text-editor"] .elementor-widget-container
.et_pb_text_inner
.et_pb_post_content
#et-main-area .et_pb_module
.wpb_text_column .wpb_wrapper
main
article
[role="main"]
#content
.content-area
.site-content
"""

#: Elements that are never text.
NOISE_SELECTORS = """
script
style
nav
footer
header
aside
noscript
iframe
svg
form
[role="navigation"]
[role="banner"]
[role="contentinfo"]
.cookie-banner
.cookie-notice
#cookie-consent
.cc-window
.gdpr-banner
.gdpr-notice
.newsletter-signup
.newsletter-form
.social-share
.share-buttons
.sidebar
#sidebar
.comments
#comments
.breadcrumb
.breadcrumbs
"""

#: Patterns of class names and ids by which a reader mode judges elements.
READABLE = {
    "unlikely": "-ad-|ai2html|banner|breadcrumbs|combx|comment|community|cover-wrap|disqus|extra|footer|gdpr|header|legends|menu|related|remark|replies|rss|shoutbox|sidebar|skyscraper|social|sponsor|supplemental|ad-break|agegate|pagination|pager|popup|yom-remote",
    "maybe": "and|article|body|column|content|main|mathjax|shadow",
    "positive": "article|body|content|entry|hentry|h-entry|main|page|pagination|post|text|blog|story",
    "negative": "-ad-|hidden|^hid$| hid$| hid |^hid |banner|combx|comment|com-|contact|footer|gdpr|masthead|media|meta|outbrain|promo|related|scroll|share|shoutbox|sidebar|skyscraper|sponsor|shopping|tags|widget",
}
UNLIKELY_ROLES = "menu menubar complementary navigation alert alertdialog dialog".split()


#: Parts of paths by which pages are taken for a company's people, products and awards, and pages of each that are fetched.
MEDIA_PAGES = {
    "team": ("/about /team /leadership /people /management /our-team /staff /executives /founders /who-we-are".split(), 3),
    "products": ("/products /solutions /platform /services /software /features /demo /tools /technology".split(), 3),
    "awards": ("/awards /certifications /recognition /achievements /accreditations /partners".split(), 2),
}
#: Images of each class that are kept.
MEDIA_CAPS = {"team": 10, "products": 10, "awards": 5}
LOGO_WORDS = "logo|brand|site-icon"
PERSON_WORDS = "team|people|staff|executive|leadership|headshot|avatar|portrait|founder|ceo|cto|director|manager|board"
PRODUCT_WORDS = "product|platform|dashboard|screenshot|demo|software|interface|solution|feature|tool|game|slot|casino|betting|sportsbook"
NO_PRODUCT_WORDS = "logo|icon|badge|arrow|button"
AWARD_WORDS = "award|badge|cert|seal|winner|recognition|trophy|medal|accredit|compliance|licensed"
SPACER_WORDS = r"spacer|pixel|arrow|button|icon\."

#: Paths under which sites have feeds, in the order in which they are tried.
FEED_PATHS = "/feed /rss /feed.xml /rss.xml /atom.xml /blog/feed /news/feed /feed/rss /feed/atom".split()

#: Claims that a verifier looks up: one pattern a line; those after the empty line are matched with case.
FACT_PATTERNS = r"""
\b\d+(?:\.\d+)?\s*(?:million|billion|trillion)\b
\bUSD\s*\d+
\bEUR\s*\d+
\bGBP\s*\d+
\bfounded\s+in\s+\d{4}\b
\bestablished\s+in\s+\d{4}\b
\blaunched\s+in\s+\d{4}\b
\bsince\s+\d{4}\b
\bheadquartered\s+in\b
\bbased\s+in\b
\bemploys?\s+(?:over\s+|more\s+than\s+|approximately\s+)?\d
\b\d+\s+employees?\b
\blicensed?\s+(?:by|in|from)\b
\bregulated\s+by\b
\bacquired\s+(?:by|for)\b
\bmerged\s+with\b
\bpartnership\s+with\b
\bsponsors?\s+(?:of|the)\b
\bpowered\s+by\b
\boperates?\s+in\s+\d+
\bover\s+\d+\s+(?:brands?|markets?|countries|games?|titles?)\b

\b\d{1,3}(?:,\d{3})+\b
\b\d+(?:\.\d+)?\s*%
\$\s*\d+
\b€\s*\d+
\b£\s*\d+
\bin\s+\d{4}\b
"""

#: What a verifier takes for general knowledge.
FACT_EXCEPTIONS = r"""
\bigaming\s+is\b
\bonline\s+gambling\s+is\b
\bthe\s+industry\s+(?:is|has|continues)\b
\bglobally\b
\bgenerally\s+(?:speaking|considered)\b
\bit\s+is\s+(?:widely|commonly|generally)\b
\bas\s+(?:one\s+of\s+)?the\s+(?:largest|biggest|most)\b
\bis\s+(?:a|an)\s+(?:popular|common|well-known|leading|major)\b
\bplays?\s+(?:a|an)\s+(?:important|key|crucial|vital)\s+role\b
\bcontinues?\s+to\s+(?:grow|expand|evolve)\b
"""
#: Stems of those of its patterns that match without a digit.
FACT_STEMS = "headquartered based licens regulated acquired merged partnership sponsor powered".split()

# What a profile's row says of where it came from, and why it has none.
PROFILE_METHODS = ("voyager", "scrapelinkedin", "none")
PROFILE_ERRORS = {"disabled": "Voyager failed, fallback disabled", "answer": "All methods failed: ScrapeLinkedIn API error: HTTP %s \u2014 %s", "unknown": "Unknown error", "none": "All methods failed: no answer"}

# What an article is written from.
WRITER_SECTIONS = ("=== COMPANY ANALYSIS ===", "=== SEO CONTENT PLAN ===", "=== SOURCE CONTENT (scraped pages) ===")
WRITER_MISSING = "Missing upstream output: %s. Run these submodules first."
WRITER_NEEDS = ("content-analyzer", "seo-planner")

# How pages are read by patterns: links, meta tags before and after their content, what is no text, what parts paragraphs.
ANCHOR = r"""(?is)<a\s[^>]*href\s*=\s*["']([^"'#][^"']*)["'][^>]*>(.*?)</a>"""
NO_LINKS = "mailto: javascript: tel: ftp: data:".split()
META_BEFORE = r"""(?i)<meta[^>]+{attribute}=["']{name}["'][^>]+content=["']([^"']+)["']"""
META_AFTER = r"""(?i)<meta[^>]+content=["']([^"']+)["'][^>]+{attribute}=["']{name}["']"""
TITLE = "(?is)<title[^>]*>(.*?)</title>"
FIRST_HEADING = "(?is)<h1[^>]*>(.*?)</h1>"
MAIN_PARTS = ["(?is)<main[^>]*>(.*?)</main>", "(?is)<article[^>]*>(.*?)</article>"]
BODY = "(?is)<body[^>]*>(.*?)</body>"
CHROME_TAGS = "script style nav footer header aside noscript".split()
BLOCK_TAGS = "p|div|h[1-6]|li|tr|blockquote|section|article|figcaption"
TEXT_BREAKS = [
    (r"(?i)<br\s*/?>", "\n"),
    (rf"(?i)</(?:{BLOCK_TAGS})>", "\n\n"),
    (rf"(?i)<(?:{BLOCK_TAGS})[^>]*>", ""),
    (r"(?i)</(?:ul|ol|table|dl)>", "\n"),
    (r"(?i)<(?:hr)[^>]*/?>", "\n---\n"),
]


def lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x]
