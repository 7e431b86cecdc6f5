"""DataFrame operators: matching, ranking, policies, tags, configurations, verification."""
