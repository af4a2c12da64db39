"""DataFrame -> DataFrame operators: actions, motion timelines, jobs, observations, alignment, clock, policy.

``scans`` holds the chunked prefix scans the ordered operators share.
"""
