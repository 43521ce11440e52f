"""Lexicons and patterns of the archive operators, as data. Operators take them as parameters; these are the defaults."""

# Patterns of positions (fixed values).
LONG = '\\b(went long|goes long|going long|enter(?:ed|s|ing)? (?:a |an )?long|(?:took|established|initiated|opened|put on|building|built|added) (?:a |an )?long|long position|net long|bullish|upside bet|leveraged long|bought|purchase[d]?|acqui(?:red|res|ring)|long exposure|long (?:the|bias)|long (?:the )?(?:bond[s]?|gilt[s]?|treasur\\w+|equit\\w+|stock[s]?|share[s]?|oil|crude|gold|silver|copper|natural gas|gas|duration|credit|the dollar|sterling|yen|euro|pound)|long (?:vol(?:atility)?|gamma|vega)|long call[s]?|bought call[s]?|call spread|overweight|accumulated (?:a |an |the )?(?:(?:long|bullish) (?:positions?|exposure)|(?:(?!(?:short|bearish)\\b)[\\w.$%\\-]+\\s+){0,3}(?:positions?|shares?|stock|equit(?:y|ies)|stake|holdings?|bonds?|calls?|call options?))|(?:added|increased) (?:to )?(?:the )?(?:long|position|stake|holdings?|exposure)|(?:built|rebuilt|raised|amassed|disclosed|acquired|took|owns?|holds?|established) (?:a |an )?(?:[\\$\\d.,]+\\+?(?:\\s*(?:billion|million|bn|mn)\\s+|\\s+))?(?:minority |majority |new |large |sizable |controlling |\\d+(?:\\.\\d+)?%\\s+)?(?:stake|equity stake|long position) in|\\d+(?:\\.\\d+)?%\\s+stake|stake in|deployed (?:capital )?(?:into|to|in)|allocated (?:capital )?to)\\b'
SHORT = '\\b(shorted|shorting|went short|goes short|going short|enter(?:ed|s|ing)? (?:a |an )?short|(?:established|initiated|opened|put on|took|built|building|added) (?:a |an )?short|sold short|short position|net short|short seller[s]?|bet(?:ting)? against|CDS buy|bearish|short exposure|leveraged short|short bias|underweight|short(?:ed)? (?:the )?(?:bond[s]?|gilt[s]?|treasur\\w+|equit\\w+|stock[s]?|share[s]?|currenc\\w+|dollar|sterling|yen|euro|pound|oil|crude|gold|silver|copper|gas|credit|duration|index)|short (?:vol(?:atility)?|gamma|vega|VIX)|selling (?:vol(?:atility)?|index vol)|sold vol(?:atility)?|(?:sold|wrote|writing|selling) call[s]?|bought put[s]?|put option[s]?|protective put|bought protection|put buyer[s]?|fad(?:e|ed|ing) the)\\b'
ARBITRAGE = '\\b(arbitrage[d]?|arb(?:ed)?|relative value|pairs trade|basis trade|convergence trade|spread trade|market neutral|merger arb|risk arb|event[\\s\\-]driven|steepener|flattener|curve (?:steepener|flattener|trade)|dispersion (?:trade|strateg\\w+|book|play)|calendar spread|time spread)\\b'
OWNS_PUTS = '\\b(?:long|bought|purchased|buying|own(?:s|ed)?|hold(?:s|ing)?)\\s+put[s]?\\b'
AFFIRMATIVE = '\\b(?:went|goes|going)\\s+(?:long|short)\\b|\\b(?:established|initiated|opened|put on|took|built)\\s+(?:a\\s+|an\\s+)?(?:long|short)\\b|\\b(?:shorted|sold short|bought puts?|bought protection)\\b|\\b(?:long|short)\\s+(?:the\\s+)?(?:bond|gilt|treasur|equit|stock|share|oil|crude|gold|silver|copper|gas|credit|duration|dollar|sterling|yen|euro|pound|volatil|gamma|vega|VIX)'

# Patterns that mark a sentence about a trade (fixed values).
TRIGGERS = (
    r'\b(?:bought|purchased|acquired|established|built|entered|initiated|opened)\b',
    r'\b(?:sold|shorted|established a short|went short on|bet against)\b',
    r'\b(?:long position|short position|net long|net short)\b',
    r'\b(?:trade[d]?|position[d]?|invest(?:ed|s|ing))\b',
    r'\b(?:CDS on|put on|call on|options on)\b',
    r'\b(?:arbitrage(?:d|s)?|arb(?:ed|s)?)\b',
    r'\b(?:hedge[d]?|hedging)\b',
    r'\b(?:profit(?:ed|s)?|loss|made \$|lost \$|gain(?:ed|s)?|return(?:ed|s)?)\b',
    r'\b(?:spread trade|basis trade|relative value|pairs trade)\b',
    r'\b(?:leveraged|levered|unlevered)\b',
)

# Whatever one of the patterns above (but AFFIRMATIVE) matches holds one of these, in lower case: change them together.
SIGNAL_STEMS = (
    'long', 'short', 'bullish', 'upside bet', 'bought', 'purchase', 'acqui', 'call', 'overweight', 'accumulated', 'position', 'stake', 'holding', 'exposure', 'deployed', 'allocated', 'against', 'cds', 'bearish',
    'underweight', 'selling', 'sold', 'put', 'fade', 'fading', 'arb', 'relative value', 'trade', 'market neutral', 'driven', 'steepener', 'flattener', 'dispersion', 'spread', 'established', 'built', 'entered', 'initiated',
    'opened', 'invest', 'options on', 'hedg', 'profit', 'loss', 'made $', 'lost $', 'gain', 'return', 'levered', 'leveraged',
)

# Instrument classes and their patterns, in order (fixed values).
INSTRUMENTS = {
    'bond': '\\b(bond[s]?|gilt[s]?|treasury(?!\\s+(?:stock|shares?|department|secretary))|treasuries|t\\.bond[s]?|t\\.note[s]?|treasury note[s]?|senior note[s]?|convertible note[s]?|subordinated note[s]?|floating rate note[s]?|promissory note[s]?|unsecured note[s]?|secured note[s]?|corporate bond[s]?|sovereign bond[s]?|IG bond[s]?|HY bond[s]?|high.yield bond[s]?|investment.grade bond[s]?|junk bond[s]?|government bond[s]?)\\b',
    'CDS': '\\b(CDS|credit default swap[s]?|credit protection|CDX|iTraxx|LCDS)\\b',
    'option': '\\b(option[s]?|put option[s]?|call option[s]?|straddle[s]?|strangle[s]?|collar[s]?|butterfly spread|condor spread|warrant[s]?|swaption[s]?|put spread[s]?|call spread[s]?|protective put|covered call|exotic option)\\b',
    'equity': '\\b(stock[s]?|share[s]?|equity|equities|common stock|preferred stock|ADR[s]?|GDR[s]?|ETF[s]?|index fund[s]?)\\b',
    'futures': '\\b(futures|future contracts?|commodity futures?|financial futures?)\\b',
    'swap': '\\b(interest rate swap[s]?|IRS swap|TRS|total return swap[s]?|variance swap[s]?|volatility swap[s]?|cross.currency swap[s]?|credit swap[s]?|swap (?:position|trade|desk|book)|swapped (?:into|out|the))\\b',
    'FX': '\\b(forex|foreign exchange|FX (?:trade|position|hedge|carry|alpha|swap|forward|option)|exchange rate|currency (?:trade|position|hedge|swap|pair|crisis|peg|attack|devaluation|appreciation|depreciation|carry)|NDF|carry trade|currency future[s]?|dollar index|DXY|EM currenc|emerging market currenc|spot rate|FX book)\\b',
    'commodity': '\\b(oil|crude|WTI|Brent|natural gas|gold|silver|copper|wheat|corn|commodity|commodities|EUA|carbon credit[s]?)\\b',
    'repo': '\\b(repo|repurchase agreement|reverse repo|haircut|repo market|repo rate)\\b',
    'weather_derivative': '\\b(weather derivative[s]?|temperature future[s]?|cat bond[s]?|catastrophe bond[s]?)\\b',
    'prediction_market': '\\b(prediction market[s]?|Polymarket|Kalshi|event contract[s]?)\\b',
    'volatility': '\\b(VIX|implied vol(?:atility)?|realized vol(?:atility)?|variance swap|dispersion trade|volatility swap|vol surface|vol regime|vol arb(?:itrage)?|long vol|short vol|selling vol|buying vol|vol trade|volatility trade|volatility (?:position|strategy|fund|hedge|bet|exposure|premium|product|index)|variance risk premium|vol premium|volatility risk premium)\\b',
}

# Patterns of quantities (fixed values).
QUANTITIES = (
    r'\$[\d,]+(?:\.\d+)?\s*(?:billion|million|trillion|bn|mn|trn|B|M|T)\b',
    r'[₹£€¥]\s*[\d,]+(?:\.\d+)?\s*(?:billion|million|trillion|crore|lakh|bn|mn|B|M)\b',
    r'[\d,]+(?:\.\d+)?\s*(?:crore|lakh)\b',
    r'[\d,]+(?:\.\d+)?\s*(?:billion|million|trillion|bn|mn|trn)\s+(?:dollars?|euros?|pounds?|yen)',
    r'\d+(?:\.\d+)?%',
    r'[\d,]+\s*basis points?',
    r'[\d,]+\s*bps?',
    r'\d+x\s+(?:leverage|return|multiple)',
    r'[\d.]+\s*(?:cents?|pence)\s+on\s+the\s+dollar',
    r'strike(?:\s+price)?\s+(?:of\s+)?[\d,.$]+',
    r'at\s+[\d,.$]+(?:\s+(?:per share|per barrel|per ton|per ounce))?',
    r'yield\s+of\s+\d+(?:\.\d+)?%',
    r'spread\s+of\s+[\d,]+\s*(?:bps?|basis points?)?',
    r'[\d,]+\s*contracts?',
    r'[\d,]+\s*shares?',
    r'notional\s+(?:of\s+)?[\d,$]+',
    r'P[&/]?L\s+of\s+[\$\d,.]+',
)

# Managers and funds (fixed values).
FUNDS = (
    'Soros', 'Ackman', 'Paulson', 'Druckenmiller', 'Buffett', 'Einhorn', 'Tepper', 'Griffin', 'Cohen', 'Dalio', 'Simons', 'Loeb',
    'Bacon', 'Andurand', 'Odey', 'Rokos', 'Klarman', 'Howard', 'Stanley Druckenmiller', 'Bill Ackman', 'George Soros',
    'John Paulson', 'David Einhorn', 'David Tepper', 'Ken Griffin', 'Steve Cohen', 'Ray Dalio', 'Jim Simons', 'Seth Klarman',
    'Paul Tudor Jones', 'Julian Robertson', 'Lee Ainslie', 'Louis Bacon', 'Alan Howard', 'Dan Loeb', 'Howard Marks',
    'Bridgewater', 'Citadel', 'Millennium', 'Point72', 'Renaissance Technologies', 'BlueCrest', 'Elliott Management',
    'Elliott Associates', 'Tiger Global', 'Tiger Management', 'LTCM', 'Long-Term Capital Management', 'Amaranth', 'Two Sigma',
    'D.E. Shaw', 'Viking Global', 'Lone Pine', 'Third Point', 'Balyasny', 'AQR', 'Winton', 'Aspect Capital', 'Brevan Howard',
    'Man Group', 'Tudor Investment', 'Glenview', 'Coatue', 'Maverick Capital', 'Pershing Square', 'Greenlight Capital',
    'Appaloosa Management', 'Baupost Group', 'Moore Capital', 'Highbridge', 'Farallon', 'Canyon Capital', 'Caxton', 'King Street',
    'Centerbridge', 'Oaktree Capital', 'Duquesne',
)

# Canonical labels of funds (fixed values).
FUND_LABELS = {
    'bill ackman': 'Ackman',
    'george soros': 'Soros',
    'john paulson': 'Paulson',
    'stanley druckenmiller': 'Druckenmiller',
    'david einhorn': 'Einhorn / Greenlight',
    'david tepper': 'Tepper / Appaloosa',
    'ken griffin': 'Griffin / Citadel',
    'steve cohen': 'Cohen / Point72',
    'ray dalio': 'Dalio / Bridgewater',
    'jim simons': 'Simons / Renaissance',
    'seth klarman': 'Klarman / Baupost',
    'paul tudor jones': 'Tudor Jones',
    'julian robertson': 'Robertson / Tiger',
    'lee ainslie': 'Ainslie / Maverick',
    'louis bacon': 'Bacon / Moore',
    'alan howard': 'Howard / Brevan',
    'dan loeb': 'Loeb / Third Point',
    'howard marks': 'Marks / Oaktree',
    'elliott management': 'Elliott',
    'elliott associates': 'Elliott',
    'renaissance technologies': 'Renaissance',
    'long-term capital management': 'LTCM',
    'greenlight capital': 'Einhorn / Greenlight',
    'appaloosa management': 'Tepper / Appaloosa',
    'baupost group': 'Klarman / Baupost',
    'oaktree capital': 'Marks / Oaktree',
    'tiger global': 'Tiger',
    'tiger management': 'Tiger',
    'maverick capital': 'Ainslie / Maverick',
    'pershing square': 'Ackman / Pershing',
}

# Negation and its scope (fixed values).
NEGATION = "\\b(?:no|not|never|without|neither|nor|cannot|can['’]t|didn['’]t|doesn['’]t|isn['’]t|wasn['’]t|weren['’]t|hasn['’]t|haven['’]t|hadn['’]t|won['’]t|wouldn['’]t|couldn['’]t|shouldn['’]t)\\b"
NEGATION_EXCEPTION = '^\\s*(?:only|just|merely)\\b'
NEGATION_STOP = '\\b(?:but|however|yet|although|though|rather|instead)\\b'

# Reference lines (fixed values).
URL = '(?:https?://|www\\.)\\S+'
URL_STEMS = ('http', 'www.')
SOURCES_HEADING = '^(?:references?|bibliography|sources?|footnotes?|further reading)(?:\\s*[:&-]+\\s*)?$'
SOURCE_MARKER = '^\\s*(?:\\[(?:\\d+|[ivxlcdm]+|[\\u00b9\\u00b2\\u00b3\\u2070-\\u2079]+)\\]|\\d{1,3}[.)])\\s*'
CITATION = '\\b(?:doi|arxiv|available at|retrieved|accessed|working paper|quarterly review|journal of|proceedings|volume\\s+\\d+|vol\\.\\s*\\d+|pp?\\.\\s*\\d+)\\b'
CITATION_LINE = '(?:\\b(?:source|article|white paper|tutorial)\\b\\.?\\s*$|\\([A-Z][a-z]{2,8}\\.?\\s+(?:\\d{1,2},?\\s+)?(?:19|20)\\d{2}\\)\\s*$|\\b[A-Z][A-Za-z-]+,\\s*(?:[A-Z]\\.(?:\\s*[A-Z]\\.)?|[A-Z][a-z]+).{0,120}\\((?:19|20)\\d{2}\\))'

# Passages about the publication, real trades, and quantities that mean something (fixed values).
META = (
    "I\\'ve put together",
    'full video breakdown',
    'Patreon member',
    'exclusive(?:ly)? for',
    'subscribe',
    'covering every fund',
    'this analysis deconstructs',
    'the following (?:analysis|breakdown|article)',
    'published exclusively',
    'breaking down (?:this|the) article',
    '^This (?:article|piece|post|analysis)',
    'upcoming (?:article|piece|post)',
    'next (?:article|section)',
    'in this (?:article|piece|post)',
    '^In this (?:article|piece|post)',
    'drawing from court documents',
    'verified sources',
    'full forensic breakdown',
    'is published exclusively',
    r'part \d+ of \d+',
    'complete (?:breakdown|analysis|guide)',
    'below is (?:a|the)',
    'this post covers',
    'at the end of this',
    'for paid subscribers',
    'upgrade to read',
    'paywall',
    'subscribe to continue',
    'become a member',
    '^Primary sources?:',
    '^(?:All )?(?:sources?|references?|citations?|data):',
    r'https?://\S+.*https?://\S+.*https?://\S+',
    '(?:Bloomberg|Reuters|FT|WSJ|CNBC|SEC|CFTC) —.*(?:Bloomberg|Reuters|FT|WSJ|CNBC|SEC|CFTC) —',
    "^(?:Bloomberg|Reuters|FT|WSJ|CNBC|Hedgeweek|BNN|BIS|Financial Times|CityAM|Barron\\'s|MarketWatch)\\s*[—–-]\\s",
    r'^(?:→|►|•|·)\s*(?:Instrument|Strategy|Trade Setup|Trade Anatomy|Definition|Execution|Note|Hedge|Step)\s*[—–:\s]',
    r'^Trade (?:\d+|Anatomy|Setup|Structure|Profile|Case)\s*[—–-]',
    r'^(?:The )?(?:six|five|four|three|two|seven|eight|nine|ten|eleven|twelve) (?:strategies|trades|methods|approaches|techniques|ways)\b',
    r'^Example:\s',
    '^(?:This|The) (?:following|above|below) (?:example|illustration|diagram|table|chart)',
    r'[—–-]\s*(?:Bloomberg|Reuters|FT|WSJ|CNBC|Hedgeweek|BNN Bloomberg|BIS|Financial Times|MarketWatch|CityAM)\s*$',
)
REAL_TRADE = (
    r'\b(bought|purchased|shorted|sold|entered|established|built|initiated|opened|acquired)\b',
    r'\b(long position|short position|net long|net short|bet (?:on|against))\b',
    r'\b(CDS on|put on|call on|options on|futures on|swap on)\b',
    r'\b(arbitrage[d]?|hedge[d]?|traded|positioned)\b',
    r'\b(profit(?:ed)? of|return(?:ed)? of|gain(?:ed)?|made \$|lost \$)\b',
    r'\b(?:fund|manager|investor|trader|desk)\s+(?:bought|sold|shorted|went|built|entered)\b',
    r'\b(?:Soros|Ackman|Paulson|Druckenmiller|Buffett|Amaranth|LTCM|Andurand|BlueCrest|Bridgewater|Citadel|Millennium|Point72|Renaissance|D\.E\. Shaw|Elliott|Tiger|Odey|Rokos)\b',
)
MEANINGFUL_QUANTITY = (
    r'\$[\d,]+(?:\.\d+)?\s*(?:billion|million|B|M)\b',
    r'\d+(?:\.\d+)?%',
    r'[\d,]+\s*(?:basis points?|bps)',
    r'at [\d,.$]+\s*(?:per share|per barrel|per unit)?',
    r'strike\s+(?:of|at)?\s*[\d,.$]+',
    r'spread\s+(?:of|at)?\s*[\d,]+',
    r'notional\s+(?:of\s+)?[\d,$]+',
)

# Phrases of the topic families (fixed values).
CAREER = (
    'career path', 'compensation', 'team economics', 'structure pods', 'pod structure', 'multi pod',
    'portfolio manager economics', 'centralized allocation', 'star portfolio managers', 'hiring', 'talent pipeline',
    'organizational design', 'organisation design',
)
MISCONDUCT = (
    'manipulation', 'manipulating', 'manipulated', 'spoofing', 'fraud', 'insider trading', 'market abuse', 'price fixing',
    'testified under oath', 'criminal case', 'criminal charges', 'arrested', 'convicted', 'indicted',
)
ENFORCEMENT = (
    'sec fined', 'cftc fined', 'sebi order', 'court documents', 'regulatory action', 'enforcement action', 'paid a fine',
    'paid fines',
)
MODEL = (
    'black scholes', 'hull white', 'avellaneda stoikov', 'sabr', 'heston', 'value at risk', 'var model', 'sharpe ratio',
    'sortino ratio', 'kelly criterion', 'covariance matrix', 'mean reversion', 'stochastic volatility', 'factor model',
    'risk model', 'risk models', 'maximum drawdown', 'downside deviation', 'ols', 'pca',
)
CRITIQUE = (
    ' is wrong', ' got wrong', 'problem', 'limitation', 'blind spot', 'bias', 'missed', 'fails', 'failed', 'lost to',
    'naive guess', 'fix', 'overstate', 'understate', 'denominator error', 'cannot see', 'can t be right', 'gets wrong',
    'broke the model', 'broke the models',
)
MARKET_STRUCTURE = (
    'market structure', 'microstructure', 'mica', 'mifid', 'central counterparty', 'clearing house', 'clearinghouse',
    'exchange outage', 'trading venue', 'dark pool', 'fixing window', 'index rebalancing', 'settlement mechanics', 'ndf market',
    'non deliverable forward',
)
EVENT = (
    'iran war', 'oil war', 'trade war', 'tariff shock', 'tariff verdict', 'invasion', 'sanctions', 'fomc', 'mpc decision',
    'budget', 'election', 'geopolitical', 'policy driven', 'fed turns', 'oil shock',
)
MECHANICS = (
    'how ', 'inside ', 'engine', 'generated', 'generates returns', 'made ', 'built ', 'extract', 'profit', 'strategy', 'playbook',
    'trade that', 'monetizes', 'deconstructing',
)
NAMED_FIRMS = (
    'aqr', 'balyasny', 'blackstone', 'bluecrest', 'bridgewater', 'capstone', 'cfm', 'citadel', 'da vinci trading', 'd e shaw',
    'futures first', 'graviton', 'greenlight', 'hrt', 'hudson river trading', 'jane street', 'jump trading', 'millennium',
    'optiver', 'pershing square', 'point72', 'qrt', 'renaissance', 'saba', 'squarepoint', 'susquehanna', 'two sigma', 'universa',
    'virtu', 'vitol', 'worldquant',
)

# Entities and their aliases (fixed values).
ENTITIES = {
    'aqr': ('aqr',),
    'bank-of-america': ('bank of america', 'bofa'),
    'bank-of-england': ('bank of england', 'boe'),
    'barclays': ('barclays',),
    'blackrock': ('blackrock',),
    'bluecrest': ('bluecrest', 'bluecrest capital'),
    'brevan-howard': ('brevan howard',),
    'bridgewater': ('bridgewater', 'bridgewater associates'),
    'calpers': ('calpers',),
    'capstone': ('capstone', 'capstone investment advisors'),
    'cfm': ('cfm', 'capital fund management'),
    'cftc': ('cftc', 'commodity futures trading commission'),
    'citadel': ('citadel', 'citadel securities'),
    'crescat': ('crescat', 'crescat capital'),
    'd-e-shaw': ('d e shaw', 'de shaw'),
    'elliott-management': ('elliott management',),
    'esma': ('esma', 'european securities and markets authority'),
    'federal-reserve': ('federal reserve', 'the fed'),
    'flow-traders': ('flow traders',),
    'goldman-sachs': ('goldman sachs',),
    'greenlight': ('greenlight', 'greenlight capital'),
    'hrt': ('hrt', 'hudson river trading'),
    'hsbc': ('hsbc',),
    'ice': ('intercontinental exchange', 'ice exchange'),
    'jane-street': ('jane street',),
    'jpmorgan': ('jpmorgan', 'jp morgan', 'j p morgan'),
    'ljm': ('ljm', 'ljm preservation and growth'),
    'ltcm': ('ltcm', 'long term capital management'),
    'man-ahl': ('man ahl',),
    'millennium': ('millennium', 'millennium management'),
    'morgan-stanley': ('morgan stanley',),
    'optiver': ('optiver',),
    'point72': ('point72', 'point 72'),
    'polymarket': ('polymarket',),
    'qvr': ('qvr', 'qvr advisors'),
    'renaissance': ('renaissance', 'renaissance technologies'),
    'sec': ('sec', 'securities and exchange commission'),
    'squarepoint': ('squarepoint', 'squarepoint capital'),
    'third-point': ('third point',),
    'two-sigma': ('two sigma',),
    'universa': ('universa', 'universa investments'),
    'virtu': ('virtu', 'virtu financial'),
    'vitol': ('vitol',),
    'worldquant': ('worldquant',),
    'xtx-markets': ('xtx markets',),
    'bitcoin': ('bitcoin', 'btc'),
    'bonds': ('bond', 'bonds'),
    'copper': ('copper',),
    'dxy': ('dxy', 'dollar index'),
    'ethereum': ('ethereum', 'eth'),
    'euro': ('euro', 'eur'),
    'futures': ('future', 'futures'),
    'gold': ('gold',),
    'natural-gas': ('natural gas',),
    'non-deliverable-forwards': ('non deliverable forward', 'non deliverable forwards', 'ndf', 'ndfs'),
    'oil': ('oil', 'crude oil', 'wti', 'brent'),
    'options': ('option', 'options'),
    'precious-metals': ('precious metal', 'precious metals'),
    'silver': ('silver',),
    'spx': ('spx', 's p x', 's and p 500'),
    'swaps': ('swap', 'swaps'),
    'treasuries': ('treasury', 'treasuries'),
    'vix': ('vix',),
    'vvix': ('vvix',),
    'yen': ('yen', 'jpy'),
    'avellaneda-stoikov': ('avellaneda stoikov',),
    'basis-trade': ('basis trade', 'basis trading'),
    'black-litterman': ('black litterman',),
    'black-scholes': ('black scholes',),
    'carry-trade': ('carry trade', 'carry trading'),
    'delta-hedging': ('delta hedge', 'delta hedging'),
    'dispersion-trading': ('dispersion', 'dispersion trade', 'dispersion trading'),
    'expected-shortfall': ('expected shortfall',),
    'factor-model': ('factor model', 'factor models'),
    'gamma': ('gamma',),
    'gamma-scalping': ('gamma scalp', 'gamma scalping'),
    'heston': ('heston', 'heston model'),
    'hull-white': ('hull white', 'hull white model'),
    'kelly-criterion': ('kelly criterion', 'fractional kelly', 'half kelly'),
    'market-making': ('market maker', 'market makers', 'market making'),
    'market-microstructure': ('market microstructure',),
    'market-structure': ('market structure', 'market structures'),
    'mean-reversion': ('mean reversion', 'mean reverting'),
    'monte-carlo': ('monte carlo',),
    'risk-parity': ('risk parity',),
    'rough-volatility': ('rough vol', 'rough volatility'),
    'sabr': ('sabr',),
    'sharpe-ratio': ('sharpe ratio',),
    'sortino-ratio': ('sortino ratio',),
    'statistical-arbitrage': ('stat arb', 'statistical arbitrage'),
    'stochastic-volatility': ('stochastic vol', 'stochastic volatility'),
    'value-at-risk': ('value at risk',),
    'variance-swaps': ('variance swap', 'variance swaps'),
    'volatility-arbitrage': ('volatility arbitrage',),
    'volatility-risk-premium': ('volatility risk premium',),
}

# Words without weight (fixed values).
STOPWORDS = (
    'a', 'about', 'after', 'against', 'all', 'also', 'an', 'and', 'any', 'are', 'as', 'at', 'back', 'be', 'because', 'been',
    'before', 'behind', 'being', 'between', 'both', 'but', 'by', 'can', 'complete', 'could', 'data', 'did', 'do', 'documented',
    'does', 'during', 'each', 'every', 'evidence', 'exact', 'few', 'finance', 'financial', 'first', 'five', 'for', 'four', 'from',
    'fund', 'funds', 'further', 'get', 'gets', 'got', 'had', 'has', 'have', 'having', 'hedge', 'her', 'here', 'hers', 'him',
    'his', 'how', 'i', 'if', 'in', 'inside', 'institution', 'institutional', 'investment', 'investors', 'is', 'it', 'its',
    'itself', 'made', 'make', 'makes', 'making', 'market', 'markets', 'may', 'might', 'million', 'more', 'most', 'much', 'must',
    'my', 'new', 'nine', 'no', 'nor', 'not', 'now', 'of', 'on', 'once', 'one', 'only', 'or', 'other', 'our', 'ours', 'out',
    'over', 'own', 'paper', 'per', 'piece', 'position', 'positions', 'research', 'return', 'returns', 'same', 'said', 'says',
    'second', 'she', 'should', 'six', 'so', 'some', 'still', 'strategy', 'strategies', 'such', 'than', 'that', 'the', 'their',
    'them', 'then', 'there', 'these', 'they', 'ten', 'third', 'this', 'those', 'three', 'through', 'to', 'too', 'trade',
    'trading', 'under', 'up', 'use', 'used', 'using', 'very', 'via', 'was', 'we', 'were', 'what', 'when', 'where', 'which',
    'while', 'who', 'why', 'will', 'with', 'would', 'year', 'years', 'you', 'your', 'neutral', 'article', 'billion', 'buy',
    'sell', 'actually', 'rather', 'roughly',
)

# Discovery of organisations by capitals (fixed values).
ORGANISATION_SUFFIXES = (
    'advisors', 'authority', 'bank', 'capital', 'commission', 'exchange', 'management', 'partners', 'research', 'securities',
    'technologies', 'university',
)
BLOCKED_CAPITALS = (
    'actionable', 'analysis', 'article', 'bottom', 'built', 'case', 'complete', 'crude', 'deep', 'documented', 'explained',
    'extract', 'extracted', 'fund', 'funds', 'generated', 'github', 'hedge', 'how', 'inside', 'lost', 'made', 'makes', 'profit',
    'profits', 'repository', 'return', 'returns', 'study', 'traded', 'trades', 'trading', 'what', 'when', 'why', 'won',
)
GENERIC_CAPITALS = (
    'advisors', 'alpha', 'approach', 'arbitrage', 'authority', 'bank', 'capital', 'central', 'data', 'equity', 'exchange',
    'financial', 'fund', 'funds', 'investment', 'management', 'market', 'markets', 'model', 'models', 'option', 'options',
    'partners', 'portfolio', 'quant', 'quantitative', 'quants', 'research', 'risk', 'securities', 'strategy', 'system', 'systems',
    'technologies', 'trade', 'trading', 'university', 'volatility',
)
CONNECTORS = (
    'and', 'for', 'of', 'the', '&',
)

# Text that is no research (fixed values).
PROMOTIONAL = '(?:\\bpatreon\\b|\\byoutube\\b|\\blinkedin\\b|\\bnotebooklm\\b|\\bsubscribe\\b|\\bsign[ -]?up\\b|\\bnewsletter\\b|\\bdiscord\\b|\\bunlock(?:ed)?\\b|\\bsupport (?:this|the) work\\b|\\bjoin (?:the |our )?(?:community|membership)\\b|\\bprefer (?:to )?(?:watch|listen)|\\bwatch (?:the )?(?:full )?video\\b|\\bvideo overview\\b|\\bcompanion (?:document|note|piece|report)\\b|\\bread the full (?:trade|mechanism|research|analysis)\\b|\\bexclusive (?:trade|research|analysis|content)\\b|\\bfollow (?:me|the research|for more)\\b|\\babout the author\\b|\\bdisclaimer\\b|\\b(?:purely|strictly) educational\\b|\\bfor (?:educational|informational) purposes?\\b|\\bnot (?:financial|investment|trading) advice\\b|\\bpart of my .{0,60}research series\\b|\\bdedicated to\\b|\\bin (?:loving )?memory of\\b|\\bpublic research journal\\b|\\bconnect with\\b|github\\.com|streamlit\\.app)'
UPDATE_NOTICE = '\\b(?:article|post|page|research|last)\\s+(?:was\\s+)?updated\\b'
URL_OR_CITATION = '(?:https?://|www\\.|\\bdoi\\s*:|\\bssrn\\b|\\barxiv\\b)'
# Whatever one of these three matches holds one of these, in lower case: change them together.
NOTICE_STEMS = (
    'patreon', 'youtube', 'linkedin', 'notebooklm', 'subscribe', 'sign up', 'sign-up', 'signup', 'newsletter', 'discord', 'unlock', 'support th', 'community', 'membership', 'prefer ', 'video', 'companion ', 'read the full', 'exclusive ',
    'follow me', 'follow the research', 'follow for more', 'about the author', 'disclaimer', 'educational', 'informational', ' advice', 'part of my', 'dedicated to', 'memory of', 'research journal', 'connect with', 'github.com',
    'streamlit.app', 'updated', 'http', 'www.', 'doi', 'ssrn', 'arxiv',
)

# Headings, in order of precedence (fixed values).
REFERENCE_HEADING = '^(?:(?:primary|verified|complete|major|data)\\s+)?(?:sources?|references?)(?:\\s*(?:&|and)\\s*(?:references?|methodology|further reading))?(?:\\s*[·:—–-]\\s*[^.!?]{1,100})?$'
HEADINGS = {
    'falsifier': '^(?:what (?:would|could) (?:change|prove|confirm|invalidate|kill|falsif)\\b.*|what changes? (?:the|this) (?:view|case)\\b.*|.*\\b(?:would|could) (?:substantially )?(?:weaken|invalidate|falsify|change) (?:the|this) (?:thesis|view|case)\\b.*|(?:\\w+\\s+){0,5}falsif(?:y|ies|iable|ication)\\b.*)$',
    'countercase': '^(?:(?:the|an?|our|strongest|obvious|main|key|one|two|three|four|five)\\s+)*(?:objections?|counter(?:case|argument|point)s?|caveats?|limitations?|risk factors|risk case|case against)\\b.*|^(?:what can go wrong|why this (?:may|might) fail|what (?:this|the data) (?:does not|doesn.t) (?:show|prove))\\b.*',
    'implementation': '^(?:the\\s+)?(?:what to (?:watch|check|do)\\b.*|actionable\\b.*|implementation\\b.*|(?:operational\\s+)?playbook\\b.*|position siz\\w*\\b.*|capacity(?: analysis| bound| ceiling| discipline)?\\b.*|decay and capacity\\b.*|practical implications?\\b.*|next steps?\\b.*|trade construction\\b.*|execution blueprints?\\b.*|the trade)$|^(?:tier|phase|part)\\s+\\w+\\s*[—–:\\-]\\s+.*(?:implementation|execution)\\b.*',
    'evidence': '^(?:(?:part|act|phase)\\s+\\w+\\s*[—–:\\-]\\s+)?(?:the\\s+)?(?:numbers?\\b.*|data (?:points?|ledger|table)\\b.*|what the (?:data|numbers?)\\b.*|evidence\\b.*|empirical\\b.*|results?\\b.*|computed\\b.*|founding paper\\b.*|financials\\b.*|financial (?:results?|statements?|record|data|performance)\\b.*|the gap\\b.*|record\\b.*|study window\\b.*|sample size\\b.*|calculation error\\b.*|verification table\\b.*|key empirical findings?\\b.*)|^.{1,90}\\b(?:primary|on-record|empirical) evidence$',
    'mechanism': '^(?:(?:part|phase)\\s+\\w+\\s*[—–:\\-]\\s+)?(?:the\\s+)?(?:mechanisms?\\b.*|mechanics\\b.*|how it works\\b.*|where .{1,80} (?:bites|comes from)\\b.*|why .{0,60}\\b(?:edge|spread|discount|premium|signal|effect|anomaly|strategy|trade|model)\\b.{0,40}\\b(?:works|matters|exists)\\b.*|convexity\\b.*|setup\\b.*|core insight\\b.*|missing term\\b.*|p&l mechanics\\b.*|execution mechanics\\b.*|mechanics of\\b.*|non-linear convexity\\b.*)$',
}
CHECKPOINT_HEADING = '^(?:what to (?:watch|check)\\b.*|(?:public |key |upcoming )?(?:checkpoints?|dates?|calendar)\\b.*|catalyst watch\\b.*|event calendar\\b.*)$'

# Evidence and events (fixed values).
NUMBER = '(?:[$€£¥]\\s?\\d|\\d[\\d,.]{0,79}\\s?(?:%|bp\\b|bps\\b|basis points?\\b|[x×]\\b|million\\b|billion\\b|trillion\\b))'
EVIDENCE_CONTEXT = '(?:return|profit|loss|spread|sharpe|volatil|variance|drawdown|revenue|assets?|notional|premium|cost|price|market share|sample|observations?|r\\s*[²2]|rmse|t-stat|beta|liquidity|carry|capacity|exposure|value|outperform|underperform)'
EVENT_WORDS = '(?:deadline|vote|consultation|decision|expir|matur|closing|hearing|amendment|feedback|release|report|meeting|review|earnings|tender|rebalance|implementation|effective)'
