"""Regexes over cleaned bid text, all case-insensitive.

``clause(n)`` is a run of up to n characters that stays within the sentence: a
full stop ends it only when whitespace and a letter follow.
"""

from __future__ import annotations


def clause(width: int) -> str:
    return f"(?:(?!\\.\\s+[A-Z])[^\\n]){{0,{width}}}?"


FLAGS = "(?iU)"
RUPEES = "(?:rs\\.?|inr|₹)\\s*([\\d,]+(?:\\.\\d+)?)"

# Earnest money (bid security).
EMD_LABEL = "(?:emd|earnest\\s+money(?:\\s+deposit)?|bid\\s+security)"
EMD = {
    "mention": "earnest\\s+money(?:\\s+deposit)?|\\bemd\\b|bid\\s+security(?!\\s+declaration)",
    "nil": f"\\b{EMD_LABEL}\\b{clause(80)}\\b(?:nil|not\\s+applicable|not\\s+required|no\\s+emd|exempt(?:ed|ion)?|zero|rs\\.?\\s*0(?:\\.00)?\\b|₹\\s*0(?:\\.00)?\\b)",
    "amount_after": f"\\b{EMD_LABEL}\\b{clause(120)}{RUPEES}",
    "amount_before": f"{RUPEES}{clause(60)}\\b(?:as\\s+)?{EMD_LABEL}\\b",
    "payment_mode": f"\\b{EMD_LABEL}\\b{clause(160)}\\b(online|net\\s?banking|neft|rtgs|demand\\s+draft|dd|bank\\s+guarantee|bg|fixed\\s+deposit|fdr|insurance\\s+surety\\s+bond|through\\s+gem\\s+pool\\s+account)\\b",
    "last_date": f"\\b{EMD_LABEL}\\b{clause(160)}(?:on\\s+or\\s+)?(?:before|by|up\\s?to|last\\s+date{clause(20)})\\s*(\\d{{1,2}}[-/\\s][A-Za-z0-9]{{2,9}}[-/\\s]\\d{{2,4}}(?:\\s+\\d{{1,2}}:\\d{{2}})?)",
    "msme_exempt": f"\\b(?:msme|mse|micro\\s+and\\s+small|udyam|nsic)\\b{clause(120)}\\bexempt(?:ed|ion)?\\b|\\bexempt(?:ed|ion)?\\b{clause(120)}\\b(?:msme|mse|micro\\s+and\\s+small|udyam|nsic)\\b",
    "startup_exempt": f"\\b(?:startup|start-up|dpiit)\\b{clause(120)}\\bexempt(?:ed|ion)?\\b|\\bexempt(?:ed|ion)?\\b{clause(120)}\\b(?:startup|start-up|dpiit)\\b",
}
EMD_PROOFS = {
    "Udyam Registration Certificate": "udyam",
    "MSME / MSE Certificate": "\\bms(?:me|e)\\s+certificate\\b",
    "NSIC Registration Certificate": "\\bnsic\\b",
    "DPIIT Startup Recognition Certificate": "dpiit|startup\\s+recognition",
}

# Performance security, bank guarantee, security deposit.
SECURITY_LABEL = "(?:performance\\s+security|e-?pbg|performance\\s+bank\\s+guarantee|security\\s+deposit)"
INSTRUMENTS = {
    "performance_security": "performance\\s+security",
    "epbg": "\\be-?pbg\\b|performance\\s+bank\\s+guarantee",
    "security_deposit": "security\\s+deposit",
}
PERCENT = "(\\d{1,2}(?:\\.\\d+)?)\\s*(?:%|percent|per\\s?cent)"
SECURITY = {
    # A bare 0 counts, the 0 inside "3.0%" does not.
    "nil": f"{SECURITY_LABEL}{clause(80)}\\b(?:nil|not\\s+applicable|not\\s+required|no\\s+performance|zero|(?<![\\d.])0(?:\\.0+)?\\s*%|rs\\.?\\s*0\\b)",
    "percentage": f"{SECURITY_LABEL}{clause(140)}{PERCENT}|{PERCENT}{clause(80)}(?:performance\\s+security|e-?pbg|performance\\s+bank\\s+guarantee)",
    "amount": f"{SECURITY_LABEL}{clause(120)}{RUPEES}",
    "validity_near": "(?:performance\\s+security|e-?pbg|performance\\s+bank\\s+guarantee)[^.]{0,240}?(\\d{1,4}\\s*(?:days?|months?|years?)[^.\\n]{0,80})",
    "validity": "(?:valid|validity)[^.\\n]{0,80}?(\\d{1,4})\\s*(days?|months?|years?)[^.\\n]{0,60}?(?:beyond|after|from)?[^.\\n]{0,60}",
    "timeline": f"(?:performance\\s+security|e-?pbg){clause(160)}within\\s+(\\d{{1,3}}\\s*(?:days?|weeks?){clause(60)})",
    "exemption": f"(?:performance\\s+security|e-?pbg|security\\s+deposit){clause(160)}exempt(?:ed|ion)?{clause(120)}",
}

# Eligibility figures.
TURNOVER = "(?:average\\s+)?annual\\s+turnover[^.\\n]{0,60}?(?:rs\\.?|inr|₹)?\\s*([\\d,]+(?:\\.\\d+)?)\\s*(lakh?s?|crores?|cr)?"
TURNOVER_SCALES = {"lakh": 1e5, "lakhs": 1e5, "crore": 1e7, "crores": 1e7, "cr": 1e7}
EXPERIENCE_YEARS = "(\\d{1,2})\\s*(?:\\+)?\\s*years?\\s+of\\s+(?:past\\s+)?experience"
