"""Row-at-a-time model of response handling, for comparison."""

import datetime as dt

POLLED = ("submitted", "failed_pdf_404")


def fetch(text):
    return "failed_pdf_fetch", 1, text, None


WAITS = ("submitted", 0, None, None)

# (status, body) -> implied state, attempts added, error, link. Written out by hand from
# the table of responses; the tests only use answers that stand here.
ANSWERS = {
    (200, '{"url":"https://x/1"}'): ("completed", 0, None, "https://x/1"),
    (200, "{}"): fetch("HTTP 200: {}"),
    (200, '{"url":""}'): fetch('HTTP 200: {"url":""}'),
    (200, "oops"): fetch("HTTP 200: oops"),
    (200, None): fetch("HTTP 200: "),
    (200, "[1]"): fetch("HTTP 200: [1]"),
    (422, '{"detail":{"pipeline_status":"processing"}}'): WAITS,
    (422, '{"detail":{"pipeline_status":"failed"}}'): (
        "failed_pdf_analysis", 0, 'terminal: {"detail":{"pipeline_status":"failed"}}', None,
    ),
    (422, '{"detail":{"session_status":"failed"}}'): (
        "failed_pdf_analysis", 0, 'terminal: {"detail":{"session_status":"failed"}}', None,
    ),
    (422, '{"detail":{"reason":"data_incomplete"}}'): (
        "failed_pdf_analysis", 0, 'terminal: {"detail":{"reason":"data_incomplete"}}', None,
    ),
    (422, '{"detail":"failed"}'): WAITS,
    (422, '{"detail":[{"reason":"data_incomplete"}]}'): WAITS,
    (422, "[]"): WAITS,
    (422, "junk"): WAITS,
    (422, None): WAITS,
    (404, None): ("failed_pdf_404", 0, "not in BQ yet", None),
    (429, None): (None, 0, None, None),
    (500, "x" * 300): fetch("HTTP 500: " + "x" * 200),
    (500, "late"): fetch("HTTP 500: late"),
    (500, None): fetch("HTTP 500: "),
    (503, "ñ" * 250): fetch("HTTP 503: " + "ñ" * 200),
    (302, None): fetch("HTTP 302: "),
    (None, None): fetch("request failed"),
}


def outcome(status, body, delivery_failed):
    answer = ANSWERS[status, body]
    if delivery_failed and answer[0] == "completed":
        return "failed_drive_upload", 1, "report delivery failed", None
    return answer


def polled(state, attempts, most):
    return state in POLLED or (state == "failed_pdf_fetch" and attempts < most)


def fold(states, responses, most=5, hours=48):
    """states: {event: (state, attempts, error, submitted_at)}; responses as rows.
    Returns {event: (state, attempts, error, url, polls)} of events that were polled."""
    result = {}
    for seq, ts, event, status, body, failed in sorted(responses, key=lambda r: (r[1], r[0])):
        if event not in states:
            continue
        state, attempts, error, submitted = states[event]
        _, _, _, url, polls = result.get(event, (None, None, None, None, 0))
        if event in result:
            state, attempts, error = result[event][:3]
        if not polled(state, attempts, most):
            continue
        if state == "submitted" and submitted is not None and submitted < ts - dt.timedelta(hours=hours):
            result[event] = ("failed_timeout_pending_analysis", attempts, f"timeout after {hours}h in submitted", None, polls + 1)
            continue
        new, added, message, link = outcome(status, body, failed)
        result[event] = (
            new or state, attempts + added, error if message is None else message, link, polls + 1
        )
    return result
