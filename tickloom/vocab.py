"""Fixed values shared by the operators.

Every list, map and constant below is a fixed value: results depend on it literally, so it is
stated here in plain text, once, and passed into operators as a default argument.
"""

from __future__ import annotations

# --- Fixed values: market constants -----------------------------------------
CANDLE_STEP_SECONDS = 60
EPOCH_MICROS_THRESHOLD = 1_000_000_000_000_000
BOOK_DEPTH_PCT = 0.005
WALL_MULTIPLE = 3
WARMUP_ROWS = 120
BACKFILL_MONTHS = 36
CHAT_TURNS = 10
NEWS_LIMIT = 15
NEWS_MIN_DESCRIPTION = 50
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# --- Fixed values: raw candle column order (the twelfth wire element is dropped) ---
RAW_CANDLE_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_volume", "trade_count", "taker_buy_base", "taker_buy_quote",
]

# --- Fixed values: ticker wire name -> column name ---
TICKER_COLUMNS = {
    "priceChange": "price_change",
    "priceChangePercent": "price_change_pct",
    "highPrice": "high_24h",
    "lowPrice": "low_24h",
    "volume": "volume_24h",
    "quoteVolume": "quote_volume_24h",
    "count": "trade_count",
    "bidPrice": "bid_price",
    "askPrice": "ask_price",
}

# --- Fixed values: what a report says of a symbol without rows ---
NO_CANDLES = "(No candle data available)"
NO_TICKER = "(No ticker trend data available)"
NO_NEWS = "(No recent news articles found for this symbol)"

# --- Fixed values: news length caps (characters) ---
NEWS_CAPS = {
    "title": 500, "description": 1000, "content": 5000, "url": 500,
    "image_url": 500, "source_name": 200, "source_url": 500,
}

# --- Fixed values: a title holding any of these is spam (substring match) ---
SPAM_TITLE_TERMS = [
    "presale", "airdrop", "giveaway", "free coins", "buy now", "100x", "1000x", "moonshot",
    "guaranteed", "act now", "pepeto", "shiba 2.0", "next dogecoin",
]

# --- Fixed values: an article must hold at least one of these (whole words) ---
RELEVANT_TERMS = [
    "crypto", "cryptocurrency", "blockchain", "defi", "nft",
    "bitcoin", "btc", "ethereum", "eth", "binance", "bnb", "solana", "sol", "xrp", "ripple",
    "cardano", "ada", "tron", "trx", "avalanche", "avax", "polkadot", "dot", "toncoin", "ton",
    "near", "aptos", "apt", "sui", "cosmos", "atom", "vechain", "vet", "internet computer", "icp",
    "ethereum classic", "etc", "algorand", "algo", "tezos", "xtz", "stacks", "stx", "hedera",
    "hbar", "bitcoin cash", "bch", "neo",
    "arbitrum", "arb", "optimism", "op", "immutable", "imx", "polygon", "matic",
    "chainlink", "link", "uniswap", "uni", "aave", "litecoin", "ltc", "filecoin", "fil",
    "the graph", "grt", "render", "thorchain", "rune", "injective", "inj", "theta",
    "theta network", "arweave",
    "dogecoin", "doge", "shiba", "shib", "pepe", "dogwifhat", "wif", "axie infinity", "axs",
    "the sandbox", "sand", "decentraland", "mana", "stellar", "xlm",
    "trading crypto", "exchange crypto", "market cap", "altcoin", "stablecoin", "web3", "token",
]

# --- Fixed values: name or abbreviation -> trading symbol ---
SYMBOL_ALIASES = {
    "bitcoin": "BTCUSDT", "btc": "BTCUSDT",
    "ethereum": "ETHUSDT", "eth": "ETHUSDT",
    "bnb": "BNBUSDT", "binance coin": "BNBUSDT",
    "solana": "SOLUSDT", "sol": "SOLUSDT",
    "xrp": "XRPUSDT", "ripple": "XRPUSDT",
    "cardano": "ADAUSDT", "ada": "ADAUSDT",
    "dogecoin": "DOGEUSDT", "doge": "DOGEUSDT",
    "polkadot": "DOTUSDT", "dot": "DOTUSDT",
    "avalanche": "AVAXUSDT", "avax": "AVAXUSDT",
    "chainlink": "LINKUSDT", "link": "LINKUSDT",
    "polygon": "MATICUSDT", "matic": "MATICUSDT",
    "litecoin": "LTCUSDT", "ltc": "LTCUSDT",
    "uniswap": "UNIUSDT", "uni": "UNIUSDT",
    "stellar": "XLMUSDT", "xlm": "XLMUSDT",
    "cosmos": "ATOMUSDT", "atom": "ATOMUSDT",
    "monero": "XMRUSDT", "xmr": "XMRUSDT",
    "tron": "TRXUSDT", "trx": "TRXUSDT",
    "near protocol": "NEARUSDT", "near": "NEARUSDT",
    "aptos": "APTUSDT", "apt": "APTUSDT",
    "sui": "SUIUSDT",
    "pepe": "PEPEUSDT",
    "shiba inu": "SHIBUSDT", "shib": "SHIBUSDT",
}

# --- Fixed values: registered symbols; delisted ones carry their last trading day ---
REGISTERED_SYMBOLS = [
    "BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT", "DOGEUSDT", "ADAUSDT", "TRXUSDT",
    "LINKUSDT", "MATICUSDT", "AVAXUSDT", "TONUSDT", "SHIBUSDT", "XLMUSDT", "BCHUSDT", "DOTUSDT",
    "UNIUSDT", "LTCUSDT", "HBARUSDT", "PEPEUSDT", "NEARUSDT", "APTUSDT", "ICPUSDT", "ETCUSDT",
    "STXUSDT", "RENDERUSDT", "CROUSDT", "ATOMUSDT", "VETUSDT", "ARBUSDT", "INJUSDT", "IMXUSDT",
    "OPUSDT", "GRTUSDT", "THETAUSDT", "FILUSDT", "ARUSDT", "MKRUSDT", "WIFUSDT", "RUNEUSDT",
    "FTMUSDT", "ALGOUSDT", "FLOWUSDT", "XTZUSDT", "AXSUSDT", "SANDUSDT", "MANAUSDT", "NEOUSDT",
    "EOSUSDT", "AAVEUSDT",
]
DELISTED_ON = {
    "MATICUSDT": "2024-09-10",
    "CROUSDT": "2023-10-04",
    "MKRUSDT": "2024-11-21",
    "FTMUSDT": "2025-03-20",
    "EOSUSDT": "2025-05-27",
}

# --- Fixed values: message-intent phrases (regular expressions, matched ignoring case) ---
TECHNICAL_PHRASES = [
    r"rsi", r"macd", r"volume", r"khối\s*lượng", r"orderbook", r"order\s*book", r"obi",
    r"candle", r"ohlc", r"nến", r"support", r"resistance", r"hỗ\s*trợ", r"kháng\s*cự",
    r"indicator", r"chỉ\s*báo", r"technical", r"chart", r"price\s*action",
    r"momentum", r"divergence", r"overbought", r"quá\s*mua", r"oversold", r"quá\s*bán",
    r"trend", r"xu\s*hướng", r"breakout", r"phá\s*vỡ",
    r"moving\s*average", r"bollinger", r"fibonacci", r"elliott", r"wave", r"pattern",
    r"ichimoku", r"stochastic", r"atr", r"adx", r"vwap", r"pivot", r"fib",
    r"spread", r"liquidity", r"thanh\s*khoản", r"bid", r"ask", r"wall",
]
NEWS_PHRASES = [
    r"news", r"tin\s*tức", r"sentiment", r"tâm\s*lý", r"catalyst", r"regulation",
    r"pháp\s*luật", r"partnership", r"hợp\s*tác", r"listing", r"delisting",
    r"hack", r"security", r"bảo\s*mật", r"sec", r"cftc", r"etf", r"approval", r"chấp\s*thuận",
    r"adoption", r"institutional", r"whale", r"cá\s*voi", r"on[\-\s]?chain",
    r"announcement", r"công\s*bố", r"rumor", r"tin\s*đồn", r"fud", r"fomo",
    r"sự\s*kiện", r"event", r"buổi\s*nói", r"conference", r"AMA",
]
COMPREHENSIVE_PHRASES = [
    r"should\s*i\s*(buy|sell)", r"nên\s*(mua|bán|giữ)\s*không",
    r"(muốn|want\s*to)\s*(buy|mua|sell|bán|invest|đầu\s*tư)",
    r"(phân\s*tích|rủi\s*ro|risk)\s*(mua|bán|đầu\s*tư|invest)",
    r"comprehensive", r"toàn\s*diện", r"forecast", r"dự\s*đoán", r"prediction",
    r"hold\s*long", r"giữ\s*lâu", r"target\s*price", r"price\s*goal",
]
GREETING_PHRASES = [
    r"xin\s*chào", r"hello", r"hi", r"hey", r"chào", r"hế\s*lo",
    r"good\s*(morning|afternoon|evening)", r"what's\s*up", r"howdy", r"yo", r"👋",
    r"cảm\s*on", r"thank", r"help", r"giúp", r"làm\s*quen",
]
