"""tidemark.plans"""
