"""They define results, so they are stated as they are."""

# fixed values: keyword -> label, in the order in which labels are given
DESIGN_KEYWORDS = (
    (("grid",), "grid-based layout"),
    (("flex",), "flexbox layout"),
    (("center", "margin: 0 auto"), "centered alignment"),
    (("space-between",), "space-between distribution"),
    (("minimal", "clean", "simple"), "minimalist design"),
    (("bold", "strong"), "bold typography"),
    (("shadow",), "shadow effects"),
    (("gradient",), "gradient styling"),
    (("rounded", "border-radius"), "rounded corners"),
    (("transparent", "rgba", "opacity"), "transparency effects"),
    (("serif", "times", "georgia"), "serif typography"),
    (("sans-serif", "arial", "helvetica", "roboto"), "sans-serif typography"),
    (("uppercase",), "uppercase text"),
    (("letter-spacing", "tracking"), "letter spacing"),
    (("padding", "margin", "gap"), "generous spacing"),
    (("clamp", "min(", "max(", "responsive units"), "fluid typography"),
    (("dark", "#000", "rgb(0", "black"), "dark color scheme"),
    (("light", "#fff", "rgb(255", "white"), "light color scheme"),
    (("primary", "accent", "brand color"), "accent colors"),
    (("hover", "transition"), "hover interactions"),
    (("animation", "@keyframes", "transform"), "animations"),
    (("smooth", "ease", "cubic-bezier"), "smooth transitions"),
    (("container", "wrapper", "max-width"), "contained layout"),
    (("full-width", "width: 100%", "fullwidth"), "full-width sections"),
    (("sticky", "fixed"), "sticky positioning"),
)

# fixed values: industries by keyword, the first that occurs
INDUSTRIES = (
    (("医療", "病院", "hospital", "clinic", "診療", "クリニック"), "Healthcare"),
    (("企業", "corporate", "コーポレート", "company"), "Corporate"),
    (("美容", "beauty", "salon", "サロン"), "Beauty"),
    (("飲食", "restaurant", "レストラン", "cafe"), "Food & Beverage"),
    (("教育", "education", "school", "スクール"), "Education"),
)

# fixed values: tones
INDUSTRY_TONES = (("Healthcare", "Professional, Trustworthy, Medical"), ("Beauty", "Elegant, Refined, Aesthetic"), ("Food & Beverage", "Warm, Inviting, Appetizing"))
CATEGORY_TONES = ((("清涼", "fresh"), "Fresh, Modern, Clean"), (("ピンク", "pink"), "Warm, Friendly, Approachable"))
WORD_TONES = ((("minimal",), "Minimalist, Clean, Simple"), (("luxury", "premium"), "Luxury, Premium, Sophisticated"))

# fixed values: hosts and names of trackers and of libraries
STYLE_CDN_WORDS = ("cdnjs", "cdn.jsdelivr", "googleapis", "bootstrapcdn", "fonts.googleapis", "cloudflare")
CDN_WORDS = ("cdnjs", "cdn.jsdelivr", "googleapis", "googletagmanager", "gtag", "google-analytics", "analytics", "cloudflare", "ajax.googleapis")
LIBRARY_NAMES = (".min.js", "bundle", "chunk", "vendor", "lib")

# fixed values: marks of build tools, patterns of obfuscated code
BUILD_MARKS = ("webpack", "rollup", "bundle", "chunk", "dist/", "build/", "/*!", "/*#", "sourcemappingurl", "sourcemap")
OBFUSCATED = (r"(?i)_0x[a-f0-9]+", r"[a-z]\s*=\s*[\x22\x27][a-z]{1,3}[\x22\x27]", r"eval\s*\(", r"atob\s*\(", r"String\.fromCharCode", r"\\x[0-9a-f]{2}")

# fixed values: hosts of social networks, link texts and where their placeholders lead
SOCIAL_HOSTS = ("facebook.com", "twitter.com", "instagram.com", "linkedin.com", "youtube.com")
LINK_WORDS = (
    (("about", "会社", "概要", "私たち"), "/about"),
    (("contact", "問い合わせ", "お問い合わせ", "連絡"), "/contact"),
    (("service", "サービス", "診療", "治療"), "/services"),
    (("product", "製品", "商品", "メニュー"), "/products"),
    (("news", "ニュース", "お知らせ"), "/news"),
    (("blog", "ブログ"), "/blog"),
    (("faq", "よくある", "質問"), "/faq"),
    (("home", "ホーム", "トップ"), "/"),
)

# fixed values: placeholder sizes of images by a word in their or their parent's classes
PLACEHOLDER = "https://picsum.photos"
IMAGE_SIZES = ((("hero", "banner", "header"), (1920, 1080)), (("thumb",), (300, 300)), (("icon", "logo"), (64, 64)))
IMAGE_SIZE = (800, 600)

# fixed values: charset names and the encodings that are tried in turn
CHARSETS = {"utf-8": "utf-8", "utf8": "utf-8", "shift_jis": "shift_jis", "shift-jis": "shift_jis", "sjis": "shift_jis", "euc-jp": "euc-jp", "eucjp": "euc-jp", "iso-2022-jp": "iso-2022-jp", "cp932": "cp932"}
TRIED_ENCODINGS = ("utf-8", "shift_jis", "euc-jp", "iso-2022-jp", "cp932")

# fixed values: prompts
TRAIN_PROMPT = """You are an elite senior creative front-end engineer specializing in brand-specific website design and development. Your expertise includes:
- Creating unique, brand-identity-driven websites that reflect each brand's personality, values, and target audience
- Writing production-ready, semantic HTML5 with proper accessibility (ARIA labels, semantic elements)
- Crafting modern, responsive CSS with mobile-first approach, CSS Grid, Flexbox, and custom properties
- Implementing smooth animations and interactions using vanilla JavaScript or modern frameworks when specified
- Ensuring cross-browser compatibility, performance optimization, and SEO best practices
- Following design specifications precisely while adding creative enhancements that elevate the brand

When given design specifications, you generate complete, working website code that:
1. Captures the brand's unique identity and visual language
2. Provides excellent user experience with intuitive navigation and clear information hierarchy
3. Is fully responsive across all device sizes
4. Includes clean, maintainable, and well-commented code
5. Implements modern web standards and best practices

Your response format:
- Start with concise design reasoning explaining your approach (2-4 bullet points)
- Follow with complete, production-ready code blocks (HTML, CSS, JavaScript)
- Ensure all code is functional, properly formatted, and ready to use

### Instruction:
"""
CHAT_PROMPT = """You are a senior creative front-end engineer who designs brand-specific websites. You specialize in creating professional, modern web designs based on design specifications.
### Instruction:
"""
RESPONSE = "\n### Response:\n"

# fixed values: texts of rendered records
PAGE_TASK = (
    "Task: Create a complete, production-ready website layout with semantic HTML structure and modern CSS for responsive design. "
    "Focus on layout structure, spacing, typography, and visual hierarchy. Use placeholder images from https://picsum.photos/ with appropriate dimensions."
)
COMPONENT_TASKS = {
    "headers": "Create a website header/navigation component with semantic HTML and modern CSS styling. Include logo, navigation menu, and responsive behavior.",
    "footers": "Create a website footer component with semantic HTML and clean CSS styling. Include links, copyright information, and social media icons if applicable.",
    "sections": "Create a content section component with semantic HTML structure and modern CSS layout. Focus on proper spacing, typography, and visual hierarchy.",
    "buttons": "Create a button component with semantic HTML and attractive CSS styling. Include hover/active states and ensure accessibility and responsive behavior.",
    "navigation": "Create a navigation menu component with semantic HTML and CSS styling. Include responsive mobile menu behavior if applicable.",
    "hero": "Create a hero/banner section component with semantic HTML and eye-catching CSS styling. Include responsive layout, heading, subheading, and call-to-action if applicable.",
    "cards": "Create a card component with semantic HTML structure and modern CSS styling. Include proper spacing, shadows, and hover effects if applicable.",
    "forms": "Create a form component with semantic HTML, accessible form elements, and clean CSS styling. Include proper labels and validation styling.",
    "typography": "Create a typography example with semantic HTML headings and text elements, styled with modern CSS. Focus on font hierarchy, spacing, and readability.",
}
PLACEHOLDER_NOTE = "Use placeholder images from https://picsum.photos/ with appropriate dimensions."
COMPONENT_REASONS = {
    "headers": "Header design establishes brand identity and navigation hierarchy. Fixed positioning ensures constant access to navigation while maintaining visual prominence.",
    "footers": "Footer design provides essential site information and secondary navigation. Clean, organized layout supports user trust and site credibility.",
    "sections": "Section layout creates visual rhythm and content hierarchy. Proper spacing and typography guide user attention through content flow.",
    "buttons": "Button design emphasizes call-to-action with clear visual hierarchy. Hover states and transitions provide interactive feedback.",
    "navigation": "Navigation design prioritizes usability and accessibility. Responsive behavior adapts to different screen sizes while maintaining functionality.",
    "hero": "Hero section creates immediate visual impact and communicates primary message. Large imagery and typography establish brand presence.",
    "cards": "Card design organizes content into digestible units. Shadows and spacing create depth and visual separation.",
    "forms": "Form design prioritizes usability and accessibility. Clear labels and validation states guide user input.",
    "typography": "Typography establishes content hierarchy and readability. Font choices and spacing create visual rhythm.",
}
TONE_REASONS = {
    "Professional": "Professional tone emphasizes trust, credibility, and clarity",
    "Modern": "Modern design emphasizes clean lines, minimalism, and contemporary aesthetics",
    "Elegant": "Elegant design emphasizes sophistication, refinement, and premium feel",
    "Bold": "Bold design emphasizes strong visual impact, high contrast, and confident styling",
    "Minimalist": "Minimalist design emphasizes simplicity, whitespace, and essential elements",
    "Creative": "Creative design emphasizes unique layouts, artistic elements, and visual interest",
}
GROUP_TASK = "Task: Create a combined {} component group with semantic HTML structure and modern CSS for layout and styling. Ensure components work together harmoniously. Use placeholder images from https://picsum.photos/ with appropriate dimensions."

# fixed values: the shell around an exported fragment
SHELL = """<!DOCTYPE html>
<html lang="en">
<head>
    <meta charset="UTF-8">
    <meta name="viewport" content="width=device-width, initial-scale=1.0">
    <title>Example {number}</title>
    <link rel="stylesheet" href="style.css">
</head>
<body>
{html}
</body>
</html>"""

# fixed values: what a model is asked for reasoning
REASON_SYSTEM = "You are an expert front-end designer who explains design decisions clearly and concisely."
REASON_TEMPERATURE, REASON_TOKENS, REASON_TIMEOUT, REASON_PAUSE = 0.7, 300, 30.0, 0.5
NO_KEYWORDS = "standard web design patterns"
REASON_PROMPT = """You are a senior creative front-end engineer analyzing a website design.

Given the following website characteristics:
{context}

Design keywords detected: {keywords}

Explain the design reasoning in 4-5 detailed bullet points:
1. Component/design purpose: Why this design approach fits the industry/brand and user needs
2. Visual design: How the visual style (tone, colors, typography, spacing) supports the brand message and creates hierarchy
3. Layout structure: Why this layout pattern (grid/flexbox/centered/etc.) was chosen and how it organizes content
4. Interactive elements: How motion, transitions, and interactions enhance user experience and convey brand personality
5. Technical implementation: Notable CSS/design techniques used and their purpose (e.g., clamp for fluid typography, CSS Grid for complex layouts, custom properties for theming)

Be specific, professional, and focus on design intent and user experience. Include design keywords like: {keywords}
Keep each point to 2-3 sentences with concrete details.
Format as bullet points starting with "- "."""
