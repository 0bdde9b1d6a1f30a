"""Wording of stored details, banner lines and rendered messages."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

# Fixed values: {names} are filled from columns.

# Run log.
CURSOR_STALLED = "커서 정체: 런 용량 < 동일 시각 항목 수"
UNREADABLE = "records cannot be read"
ITEMS_FAILED = "item {n}건 실패"

# Check details.
ALL_SOURCES = "(전체)"
FAILS_IN_A_ROW = "연속 실패 {n}회"
FETCH_FAILED = "수집 실패"
NORMAL = "정상"
SILENT_STOP = "성공으로 기록됐으나 수신 0건 — 조용한 중단"
RECEIVED = "수신 {n}건"
NEVER_SUCCEEDED = "성공 이력 없음"
LAST_SUCCESS = "마지막 성공 {hours}시간 전"
TOO_FEW_RUNS = "실행 {n}회 — 판정 불가"
CURSOR_STUCK = "커서 미전진 + 신규 0건 — 무증상 정체 의심"
CURSOR_MOVES = "커서 정상 전진"
NO_BASELINE = "동일 요일유형 관측 {n}일 — 기준선 부족(최소 {least}일)"
VOLUME = "신규 {n}건 ({day_type} 중앙값 {median})"
TOPIC_SHARE = "{label} 토픽이 {percent}% 차지"
SAME_TITLES = "제목이 같은 서로 다른 문서 {n}쌍"
NO_DUPLICATES = "중복 없음"

# Banner.
SEVERITY_LABELS = {"critical": "심각", "warn": "경고"}
WARNING = "[{severity}] {check} · {source} — {detail}"
MORE_WARNINGS = "…외 {n}건"
UNDECIDED = "판정 불가 {n}건 (기준선 미확보 — 이력이 쌓이면 자동 해소)"

# Digest.
SOURCE_LABELS = {"arxiv": "논문", "hackernews": "HN", "github": "GitHub"}
NO_BODY = "_(본문 없음 — 링크 참고)_"
ITEM_SECTION = "*<{url}|{title}>*\n{summary}"
ITEM_CONTEXT = "`{source}` · {label} · 관심도 {affinity} · {time}"
BANNER_MARK = "⚠️ "
SUMMARY_FAILED = "요약 생성 실패 — 원문으로 대체했습니다."


def fill(template: str, **values: Column) -> Column:
    """The template with its names replaced by column values, as text."""
    pieces: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(values[name].cast("string"))
    return F.concat(*pieces)
