"""The three jobs end to end: publish a corpus, collect one, build chat data from it."""
