"""Word tables used by the text functions."""

# The English stop-word list the tweet cleaner removes.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at "
    "by for with about against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn "
    "doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Own polarity scores in [-1, 1].
POLARITY = {
    "amazing": 0.8, "awesome": 0.9, "best": 1.0, "better": 0.5, "brilliant": 0.9, "calm": 0.3,
    "clean": 0.4, "clear": 0.1, "easy": 0.4, "efficient": 0.4, "enjoy": 0.4, "excellent": 1.0,
    "fair": 0.6, "fast": 0.2, "fine": 0.4, "fresh": 0.3, "friendly": 0.4, "glad": 0.5, "good": 0.7,
    "great": 0.8, "happy": 0.8, "helpful": 0.4, "honest": 0.6, "improved": 0.3, "love": 0.5,
    "lovely": 0.5, "nice": 0.6, "perfect": 1.0, "pleasant": 0.7, "positive": 0.2, "proud": 0.8,
    "quick": 0.3, "reliable": 0.5, "rich": 0.4, "safe": 0.5, "smooth": 0.4, "strong": 0.4,
    "success": 0.3, "successful": 0.8, "superb": 1.0, "sure": 0.5, "thanks": 0.2, "useful": 0.3,
    "wonderful": 1.0, "angry": -0.5, "awful": -1.0, "bad": -0.7, "boring": -1.0, "broken": -0.4,
    "cheap": 0.4, "corrupt": -0.5, "crazy": -0.6, "dangerous": -0.6, "dead": -0.2, "difficult": -0.5,
    "dirty": -0.6, "expensive": -0.5, "fail": -0.5, "failed": -0.5, "failure": -0.3, "false": -0.4,
    "hard": -0.3, "hate": -0.8, "horrible": -1.0, "late": -0.3, "lost": -0.3, "negative": -0.3,
    "painful": -0.7, "poor": -0.4, "sad": -0.5, "scarce": -0.3, "sick": -0.7, "slow": -0.3,
    "sorry": -0.5, "stupid": -0.8, "terrible": -1.0, "tired": -0.4, "ugly": -0.7, "unfair": -0.5,
    "unhappy": -0.6, "useless": -0.5, "violent": -0.8, "weak": -0.4, "worse": -0.4, "worst": -1.0,
    "wrong": -0.5,
}
BOOSTERS = {"very": 1.3, "really": 1.2, "extremely": 1.5, "so": 1.1, "slightly": 0.5, "fairly": 0.8}
NEGATIONS = ("not", "no", "never", "cannot", "without")
NEGATION_FACTOR = -0.5
