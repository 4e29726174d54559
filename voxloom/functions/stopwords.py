"""Stop words: English and Arabic fillers, never a negation."""

from __future__ import annotations

# Words that turn a sentence round and are therefore never stop words.
NEGATIONS = (
    "لا ما مو مب ليس ليست لست بدون بلا لم لن "
    "no not never none nor without cannot"
).split()

# The public scikit-learn list of 318 English stop words.
ENGLISH = (
    "a about above across after afterwards again against all almost alone along already also although always "
    "am among amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as "
    "at back be became because become becomes becoming been before beforehand behind being below beside "
    "besides between beyond bill both bottom but by call can cannot cant co con could couldnt cry de describe "
    "detail do done down due during each eg eight either eleven else elsewhere empty enough etc even ever "
    "every everyone everything everywhere except few fifteen fifty fill find fire first five for former "
    "formerly forty found four from front full further get give go had has hasnt have he hence her here "
    "hereafter hereby herein hereupon hers herself him himself his how however hundred i ie if in inc indeed "
    "interest into is it its itself keep last latter latterly least less ltd made many may me meanwhile might "
    "mill mine more moreover most mostly move much must my myself name namely neither never nevertheless next "
    "nine no nobody none noone nor not nothing now nowhere of off often on once one only onto or other others "
    "otherwise our ours ourselves out over own part per perhaps please put rather re same see seem seemed "
    "seeming seems serious several she should show side since sincere six sixty so some somehow someone "
    "something sometime sometimes somewhere still such system take ten than that the their them themselves "
    "then thence there thereafter thereby therefore therein thereupon these they thick thin third this those "
    "though three through throughout thru thus to together too top toward towards twelve twenty two un under "
    "until up upon us very via was we well were what whatever when whence whenever where whereafter whereas "
    "whereby wherein whereupon wherever whether which while whither who whoever whole whom whose why will "
    "with within without would yet you your yours yourself yourselves"
).split()

# Arabic function words, then Gulf, Saudi and Egyptian fillers.
ARABIC = (
    "في من على الى إلى عن مع هذا هذه ذلك التي الذي كان كانت ما لا لم لن ان أن إن او أو "
    "ثم كل بعد قبل عند هو هي هم انا أنا نحن انت أنت كما قد كذلك حتى اذا إذا لكن بل يا و ف "
    "ب ل ك هناك بين دون غير فيه فيها لها له به بها علي اليه إليه منها منه عليه عليها وهو وهي "
    "كنت يكون تكون شي شيء جدا جداً اي أي هل نعم "
    "مو اللي شنو وش ويش بس وانا ليش كذا شو ايش وين ولا مش فين ايه ازاي دي ده عشان علشان "
    "يعني طيب لي لسا لسه للحين حقي حق عاد احنا انتو انتم هالشي كيف وشو خلاص زي كده برضه برضو "
    "عم قاعد قاعده صار صارلي بقالي بقاله مره مرة"
).split()


def _unified(word: str) -> str:
    return word.translate(str.maketrans("أإآىة", "ااايه", "ـًٌٍَُِّْ"))


def stop_words(normalize: bool = False) -> list[str]:
    """The effective list, sorted. ``normalize`` also brings the Arabic words into the form that
    cleaned text has; without it a few of them never match."""
    arabic = set(ARABIC) - set(NEGATIONS)
    if normalize:
        arabic |= {_unified(w) for w in arabic}
    return sorted((set(ENGLISH) | arabic) - set(NEGATIONS))
