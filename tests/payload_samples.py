import json


def payload(symbol, days, zone="UTC", **meta):
    """``days``: date -> (open, high, low, close, volume)."""
    names = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
    head = {"5. Time Zone": zone, **meta}
    if symbol is not None:
        head["2. Symbol"] = symbol
    if zone is None:
        del head["5. Time Zone"]
    series = {day: {n: str(v) for n, v in zip(names, values)} for day, values in days.items()}
    return json.dumps({"Meta Data": head, "Time Series (Daily)": series}, indent=2)
