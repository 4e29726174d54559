"""Fixed values of the per-topic analysis: the output contract and the texts sent to the model."""

# Keys every answer must have, in the order they are checked.
REQUIRED_KEYS = (
    "business_name",
    "description",
    "root_cause",
    "severity",
    "sentiment",
    "recommended_actions",
)
# Allowed severities, sentiments, and names too general to be accepted.
SEVERITIES = ("عالية", "متوسطة", "منخفضة")
SENTIMENTS = ("إيجابي", "سلبي", "محايد", "مختلط")
GENERIC_NAMES = (
    "مشكلة عامة",
    "خدمة العملاء",
    "مشكلة",
    "خدمة",
    "عام",
    "تعليقات",
    "شكوى",
    "موضوع",
    "ملاحظات",
    "غير محدد",
)
# Messages of the checks.
MISSING_KEY = "المفتاح ناقص: "
BAD_SEVERITY = "severity غير صحيح"
BAD_SENTIMENT = "sentiment غير صحيح"
BAD_ACTIONS = "recommended_actions يجب أن تكون ٣ عناصر"
BAD_NAME = "business_name يجب أن يكون ٢-٤ كلمات ومميزًا"

# The answer used when the model keeps failing.
FALLBACK_NAME = "موضوع غير محدد"
FALLBACK_NAME_PAD = " للعملاء"
FALLBACK_DESCRIPTION = "تجميع تلقائي من الكلمات المفتاحية والتعليقات الممثلة (تعذّر تحليل النموذج)."
FALLBACK_ROOT_CAUSE = "غير واضح من التعليقات المتاحة"
FALLBACK_SEVERITY = "متوسطة"
FALLBACK_SENTIMENT = "محايد"
FALLBACK_ACTIONS = (
    "مراجعة تعليقات هذا الموضوع يدويًا",
    "تحديد الإجراء المناسب حسب المحتوى",
    "متابعة معدّل تكرار الموضوع",
)

# The topic prompt up to the figures of the topic.
TOPIC_PROMPT_HEAD = """أنت محلل تجربة عملاء. حلّل التعليقات التالية حول موضوع واحد فقط، وأخرج JSON فقط.

التعليقات قد تكون عربية أو إنجليزية أو مختلطة، وقد تحتوي على لهجات أو أخطاء كتابية.

قاعدة مهمة: حجم الموضوع ونسبته يدلان على كثرة التكرار فقط، ولا يرفعان severity وحدهما. حدّد الخطورة بناءً على نوع المشكلة وأثرها على العميل.

المشاعر:
- مدح/شكر/رضا ← "إيجابي"
- شكوى/معاناة ← "سلبي"
- سؤال/استفسار فقط ← "محايد"
- إيجابي وسلبي معًا ← "مختلط"

الخطورة:
- "عالية" فقط للمشكلات الحرجة: مشاكل مالية أو دفع، منع إكمال الخدمة، حجب الوصول للحساب، مخاطر قانونية أو امتثال، أو فشل متكرر يمنع الإنجاز.
- "متوسطة" لمشكلات مزعجة غير حرجة: تأخير، ضعف متابعة، غموض الإجراءات، إزعاج.
- "منخفضة" للمدح والشكر والاستفسارات البسيطة والاقتراحات الطفيفة.

التعليمات:
- اعتمد على التعليقات الممثلة كدليل رئيسي، والكلمات المفتاحية كدليل مساعد فقط.
- لا تفترض أن كل موضوع شكوى.
- لا تضف معلومات غير مذكورة في التعليقات.
- business_name: اسم مميز من ٢ إلى ٤ كلمات عربية، بدون أسماء عامة.
- description: جملتان إلى ثلاث جمل تصف ما يشعر به العميل فعليًا.
- root_cause: السبب الجذري الظاهر، وإذا لم يكن واضحًا اكتب "غير واضح من التعليقات المتاحة".
- recommended_actions: ثلاثة إجراءات عملية محددة بالضبط (٣ عناصر).
- كل القيم بالعربية الفصحى.
- أخرج كائن JSON واحد فقط يبدأ بـ { وينتهي بـ }، بدون أي نص أو Markdown.

مثال للتنسيق فقط، لا تنسخه:
التعليقات: "التطبيق بطيء ويعلق"، "شاشة بيضاء وأسكره"، "ثقل بعد التحديث"
{"business_name":"بطء التطبيق وتعليقه","description":"العملاء يعانون من بطء التطبيق وتعليقه المتكرر، وبعضهم يضطر لإغلاقه. تظهر التعليقات أن المشكلة مرتبطة بتجربة استخدام مزعجة بعد التحديث.","root_cause":"تراجع أداء التطبيق بعد التحديث الأخير حسب ما يظهر من التعليقات.","severity":"متوسطة","sentiment":"سلبي","recommended_actions":["مراجعة أداء التطبيق بعد التحديث الأخير","اختبار التطبيق على الأجهزة الأكثر استخدامًا","إصدار تحسين عاجل لتقليل التعليق والبطء"]}

المطلوب:
"""
# The lines with a topic's own figures; %s marks where a value goes.
SIZE_LINE = "حجم الموضوع: %s تعليق (%s%% من الإجمالي).\n"
DUPLICATE_NOTE = "ملاحظة: يحتوي الموضوع على %s تعليقًا متكررًا (التكرار إشارة طلب، ولا يرفع الخطورة)."
KEYWORD_LINE = "الكلمات المفتاحية: "
SAMPLES_LINE = "التعليقات الممثلة:\n"
TOPIC_PROMPT_TAIL = "\n\nأخرج JSON فقط:"
LIST_COMMA = "، "

# What follows the first prompt when its answer was refused.
RETRY_HEAD = "\n\nتنبيه: المخرج السابق كان غير صالح بسبب: "
RETRY_SEPARATOR = "؛ "
RETRY_TAIL = """.
صحّح والتزم تمامًا: ٦ مفاتيح بالضبط، severity من (عالية|متوسطة|منخفضة)، sentiment من (إيجابي|سلبي|محايد|مختلط)، recommended_actions ٣ عناصر بالضبط، business_name من ٢-٤ كلمات عربية ومميز وغير عام. أرجع JSON فقط."""

# The executive prompt around its topic lines.
EXECUTIVE_HEAD = "أنت محلل تجربة عملاء. هذه المواضيع المكتشفة من ملاحظات العملاء:\n\n"
EXECUTIVE_LINE = "- %s (عدد=%s): %s"
EXECUTIVE_TAIL = """

اكتب ملخصًا تنفيذيًا موجزًا بالعربية يحتوي على:
1) أبرز ٣-٥ نتائج،
2) ٣-٥ توصيات عملية.
استخدم نقاطًا قصيرة."""
EXECUTIVE_FAILED = "(executive report unavailable: %s)"
