"""DataFrame operators: staging, features, rules, detectors, evaluation."""
