"""Rules and messages that tests start from."""


def rule(rule_id, value, kind, collector_type="track", **more):
    base = {
        "tag": "test",
        "value": value,
        "status": "active",
        "description": "rule of a test",
        "appid": "test-appid",
        "date_added": "2016-05-10 16:58:34",
        "orig_type": kind,
        "rule_type": collector_type,
        "rule_id": rule_id,
    }
    return {**base, **more}


def tweet(**more):
    base = {
        "id_str": "701594000000000001",
        "created_at": "Mon Feb 22 01:34:53 +0000 2016",
        "text": "@someone Happy Birthday to you",
        "user": {"id_str": "17919972", "screen_name": "Writer"},
        "entities": {"hashtags": [], "urls": [], "user_mentions": []},
        "lang": "en",
        "truncated": False,
        "geo": None,
    }
    return {**base, **more}
